"""Reading and writing: raw CSV, master workbooks, partitioned outputs, and caches with a signature."""
