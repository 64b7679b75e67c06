import pytest

from millrace.llm.common import tune

ODD_TEXTS = [None, "", " ", "\n\n", "one", "Two words", "É É é", "a\nb\na\nb\n", "\x00\x1c nul", "x" * 5000, "ha " * 3000,
             "line one is here\nline two is here\n" * 40, "日本語 テキスト 日本語 テキスト", "tab\tand\x0bvt", "<|endoftext|> end"]


@pytest.fixture(scope="session")
def llm(spark):
    return tune(spark)


@pytest.fixture
def odd(llm):
    """Documents with every odd case: null ids, hosts and texts, repeated rows, clashing columns."""
    rows = [(i, t, "src", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id at all", None, 1), (None, None, None, None), (3, ODD_TEXTS[3], "src", 3), (4, "one", "src", 4), (5, "other text", "b", 0)]
    return llm.createDataFrame([(*r, "x", 1.0, "y") for r in rows],
                               "doc_id bigint, text string, source string, n_chars bigint, fingerprint string, n_words double, fp string")


@pytest.fixture
def empty(llm):
    return llm.createDataFrame([], "doc_id bigint, text string, source string, n_chars bigint")
