from custodia.sources.files import (  # noqa: F401
    append_batched,
    create_partitioned_table,
    keep_columns,
    load_columns,
    read_declared_partitions,
    read_lookup,
    read_partitions,
    read_table,
    write_flat,
    write_partitioned,
    write_report,
)
from custodia.sources.retention import expired_partitions  # noqa: F401
from custodia.sources.snapshots import latest_snapshot, publish_snapshot, snapshot_inventory  # noqa: F401
from custodia.sources.versions import VersionedTable  # noqa: F401
