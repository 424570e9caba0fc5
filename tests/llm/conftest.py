import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """doc_id -> text, in order."""
    return {r.doc_id: r.text for r in documents.orderBy("doc_id").collect()}


LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 4_000

#: nulls, empty and very long texts, ties, repeated rows, repeated ids
ODD = [
    (None, "a text without an id, of a few words"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "the same text twice, and a few words more"),
    (5, "the same text twice, and a few words more"),
    (6, "the same text twice, and a few words more"),
    (7, LONG),
    (8, LONG + "tail"),
    (8, "another text of a repeated id 中文 \U0001f600 \x00 end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with more columns that have the names of results and helpers."""
    names = (
        "n_shingles component_id kept id key sig shard slot size n_words _q votes posterior held_out lang_pred score"
        " start length part sequence_id n_tokens ids_crc32 decoded_sha256 n_lines license nth segment family"
    ).split()
    rows = [(i, t, "xx" if t and i != 4 else None, "s", 0, *["odd"] * len(names)) for i, t in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
