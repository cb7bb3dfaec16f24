"""Sources and sinks: parquet test tables, markdown corpora, snapshot tables, append logs."""
