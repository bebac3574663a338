"""DuckDB SQL answers, written second by second instead of by intervals and windows."""
