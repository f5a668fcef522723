from custodia.streaming.jobs import (  # noqa: F401
    apply_changes_stream,
    event_stream,
    run_log_stream,
    series_stream,
    write_available,
)
