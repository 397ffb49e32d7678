from tidewater.sources.tables import read_table, stock_seed  # noqa: F401
from tidewater.sources.files import (  # noqa: F401
    read_event_stream, read_bounded, read_csv, read_parquet, read_json_documents, inline_rows,
)
from tidewater.sources.jdbc import read_jdbc_table  # noqa: F401
