from catalytics.sources.io import (
    cut_lineage,
    load_model,
    read_raw_csv,
    read_stage,
    read_table,
    save_model,
    scratch_path,
    sql_query,
    write_csv,
    write_stage,
)

__all__ = [
    "cut_lineage",
    "load_model",
    "read_raw_csv",
    "read_stage",
    "read_table",
    "save_model",
    "scratch_path",
    "write_csv",
    "sql_query",
    "write_stage",
]
