import pytest

CLASH = ("digest", "keep_id", "size", "position", "score", "rid", "label", "class_id", "shard", "lang_pred", "n_tokens", "line")


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, with extra columns whose names clash with the operators' own."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)))[:4] + (len(r[1] or ""),) + ("x",) * len(CLASH) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
        return spark.createDataFrame(full, schema)

    return build


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}
