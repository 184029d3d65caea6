import pytest

WORDS = ("alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kapok larch maple nutmeg oak pine "
         "quince rowan spruce teak umbrella viburnum willow yew zelkova").split()


def prose(seed: int, n: int) -> str:
    """n pseudo-random words."""
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + str(state // 7 % 97))
    return " ".join(out)


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text) pairs, with extra columns of clashing names."""
    def make(texts):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 1, "x", 2, "y", 3, [1]) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, id int, h string, "
            "n_words int, slot string, shard int, keys array<int>")
    return make


@pytest.fixture
def odd(docs):
    """Null and blank texts, a null id, repeated rows, a long text, ties."""
    return docs([(1, None), (2, ""), (3, " \t\n "), (None, prose(5, 80)), (4, prose(4, 80)),
                 (4, prose(4, 80)), (5, prose(4, 80)), (6, prose(6, 30_000)), (7, "é ß 日本 \U0001f600"),
                 (8, "x" * 5000)])
