"""The pipeline over the TPC-H-like test tables, with reference SQL for each query."""
