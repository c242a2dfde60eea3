"""Operators: functions from DataFrame to DataFrame."""

from wattspan.operators.alerts import (
    classify_alert,
    critical_alert_count,
    critical_alerts,
    first_alerts,
)
from wattspan.operators.documents import (
    first_by_key,
    flatten_readings,
    latest_by_key,
    to_documents,
    with_doc_id,
    with_epoch_ms,
)
from wattspan.operators.filters import (
    filter_anomalies,
    filter_region,
    latest_time,
    region_options,
    time_range,
)
from wattspan.operators.kpis import (
    demand_by_region,
    generation_by_source,
    kpi_anomaly_count,
    kpi_avg_cost,
    kpi_renewable,
    kpi_reserve_margin,
    kpi_summary,
)
from wattspan.operators.parse import (
    parse_readings,
    to_messages,
    with_event_time,
    with_processed_at,
)
from wattspan.operators.quality import (
    quality_report,
    revalidate,
    split_for_lake,
    split_rejects,
    tag_for_lake,
    tag_quality,
    validate_source,
    with_soft_fault,
)
from wattspan.operators.spikes import demand_spikes, stage_baseline
from wattspan.operators.windows import (
    carbon_heatmap,
    demand_vs_generation,
    flat_window,
    frequency_trend,
    hourly_baseline,
    hourly_trend,
    regional_window,
)

__all__ = [name for name in dir() if not name.startswith("_")]
