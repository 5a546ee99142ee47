"""What the tests of the training-data operators share."""

import hashlib

SF = "/root/testdata/sf0.001"
#: The columns of documents and some whose names the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, rank_id long, key long, "
          "digest string, _task long, n_words long, component string")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def make(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang); the other columns are null or junk."""
    full = []
    for r in rows:
        doc_id, text, lang = (*r, None)[:3]
        full.append((doc_id, text, lang, None, None if text is None else len(text), True, -1, 5, "x", None, None, "c"))
    return spark.createDataFrame(full, SCHEMA)


PASSAGE = " ".join(f"word{i}" for i in range(60))
