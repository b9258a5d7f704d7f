import pytest

WORDS = [f"word{i}" for i in range(400)]


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    """Documents with every odd case, stored: nulls, empty and long texts, repeated rows, clashing columns."""
    base = " ".join(WORDS[:120])
    near = base.replace("word60 ", "changed ")
    rows = [(1, base), (2, base.replace(" ", "\t ")), (3, near), (4, None), (5, ""), (6, " "), (7, "short"), (7, "short"),
            (None, "short"), (8, " ".join(WORDS[200:] * 300)), (9, "a" * 700), (10, "Ünïcödé 😀 " * 60), (11, "<|endoftext|>x\x1cy")]
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    (spark.createDataFrame([(*r, "en", "s", 1, 2) for r in rows],
                           "doc_id long, text string, lang string, source string, _text int, label int")
     .repartition(3).write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
