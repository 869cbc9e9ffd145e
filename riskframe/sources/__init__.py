from riskframe.sources.io import (  # noqa: F401
    read_table, scan, stage_csv, read_stage, full_refresh, ensure_namespace,
    write_metrics, write_report, log_run, save_model, load_model, TABLES, table_path,
)
from riskframe.sources.loans import loan_table  # noqa: F401
