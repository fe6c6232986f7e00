import pytest

#: Columns that a documents table may carry besides; some clash with names the operators use inside.
EXTRA = "lang string, source string, n_chars long, row_id long, id long, kept boolean, words string, copies int"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, source]) to a documents table with extra, clashing columns."""
    def make(rows, parts=2):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, 5, 6, True, "w", 9) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}").coalesce(parts)
    return make
