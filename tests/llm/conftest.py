import pytest

CLASHING = ("fp", "lo", "hi", "root", "component_id", "kept", "owner", "start", "end", "first", "run", "ids", "score", "label",
            "id", "l_id", "m_id", "r_id", "host", "vote", "word", "rank", "spans", "digest", "lines", "item_id", "__text2")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
TEXTS = (None, "", " \n\t ", "one", "two words", "The same text again and again in one more line.", "The same text again and again in "
         "one more line.", LONG, LONG + " end", "é" * 3000, "日本語のテキスト 😀 と絵文字", "\x00\x01 odd \x7f", "a" * 20_000,
         "nl\n" * 4000, "token = \"" + "ab12" * 8 + "\" rest of it")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, None, None, None, None), (None, "no id here", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs.repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
