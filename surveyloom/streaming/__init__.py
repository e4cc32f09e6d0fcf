"""Row-local stages on a stream of survey rows."""
