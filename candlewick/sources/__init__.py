from .bronze import latest_bronze, read_bronze, write_bronze
from .files import default_seed, read_csv, read_seed
from .scratch import materialise, scratch_path
from .tables import append_audit, compact_silver, read_table, setup_tables, write_model

__all__ = [
    "append_audit",
    "compact_silver",
    "default_seed",
    "latest_bronze",
    "materialise",
    "read_bronze",
    "read_csv",
    "read_seed",
    "read_table",
    "scratch_path",
    "setup_tables",
    "write_bronze",
    "write_model",
]
