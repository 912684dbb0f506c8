"""Row-local identification on streaming DataFrames."""
