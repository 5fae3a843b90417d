"""quillstone: a PySpark engine for time-stamped evidence and question/answer analytics."""
