from custodia.plans.jobs import (  # noqa: F401
    TripLayout,
    curated_trips,
    governed_run,
    lookup_gate_job,
    metrics_workflow,
    monthly_enriched,
    quality_report_job,
    star_job,
    vendor_dedup_job,
    run_log_state,
    zone_duplicates_job,
)
