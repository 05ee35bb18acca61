from acctcube.sources.readers import (
    decode_fixed_width,
    read_csv,
    read_csv_checked,
    read_fixed_width,
    read_in_order,
    read_landed,
)
from acctcube.sources.store import CommitConflict
from acctcube.sources.writers import (
    in_order,
    save_bucketed,
    save_table,
    write_csv,
    write_named,
    write_records,
    write_split,
)

__all__ = [
    "CommitConflict",
    "decode_fixed_width",
    "in_order",
    "read_csv",
    "read_csv_checked",
    "read_fixed_width",
    "read_in_order",
    "read_landed",
    "save_bucketed",
    "save_table",
    "write_csv",
    "write_named",
    "write_records",
    "write_split",
]
