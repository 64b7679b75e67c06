"""Every registered query over whole tables, against SQL or a version by brute force."""

import hashlib
import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import bpe, quality_model, queries
from millrace.llm.common import table
from test_katz import brute as brute_katz, close
from test_line_dedup import brute as brute_dedup, chunks_of, plain
from test_scans import brute_hits, brute_kept, brute_rules, brute_spans
from test_simhash import brute_groups, brute_print

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def items(duck):
    return duck.execute("SELECT item_id, text FROM benchmark").fetchall()


def rows_of(llm, name):
    return queries.QUERIES[name](llm, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(llm, duck, name):
    df = queries.QUERIES[name](llm, SF)
    cursor = duck.execute(queries.ORACLES[name])
    there = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(there)
    want = sorted(str([r[there.index(c)] for c in df.columns]) for r in cursor.fetchall())
    assert sorted(str(list(r)) for r in df.collect()) == want


def test_op1(llm, documents):
    got = {r.doc_id: r for r in rows_of(llm, "op1_secrets")}
    for doc, text, _ in documents:
        spans = brute_spans(text)
        told = [f"{k}:{a}:{b}" for a, k, b in spans]
        r = got[doc]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(",".join(told))
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == told


def test_op3_finds_every_notice(llm, documents):
    got = {r.doc_id: r.licenses.split(",") for r in rows_of(llm, "op3_licenses")}
    notices = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = {d: {name for notice, name in notices.items() if notice in t} for d, t, _ in documents}
    assert any(want.values())
    assert all(want[d] <= set(got[d]) for d in want)


def test_op4(llm, documents, items):
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows_of(llm, "op4_decontaminate")}
    assert got == brute_hits([r[:2] for r in documents], items)


def test_op5(llm, documents):
    prints = {d: brute_print(t) for d, t, _ in documents}
    groups = brute_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(llm, "op5_simhash")}
    assert got == {d: (f"{prints[d]:016x}", groups[d]) for d in prints}


def test_op6(llm, documents):
    got = {r.doc_id: r for r in rows_of(llm, "op6_quality_rules")}
    kept = dict(brute_kept(documents, 20))
    for doc, text, _ in documents:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text)
        assert r.kept == kept[doc]


def dedup(llm, rows):
    chunked = {t: [plain(c) for c in r] for t, r in zip(*_chunked(llm, [t for _, t in rows]))}
    return dict(brute_dedup(rows, chunked))


def _chunked(llm, texts):
    from millrace.llm.line_dedup import line_chunks
    df = line_chunks(llm.createDataFrame(list(enumerate(texts)), "i int, t string"), "t")
    return texts, [r["__chunks"] for r in df.orderBy("i").collect()]


def test_op7(llm, documents):
    want = dedup(llm, [r[:2] for r in documents])
    got = {r.doc_id: r.text_sha256 for r in rows_of(llm, "op7_line_dedup")}
    assert got == {d: sha(t) for d, t in want.items()}
    assert chunks_of


def test_op9(llm, documents):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows_of(llm, "op9_bpe")}
    for doc, text, _ in documents:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                            sha(library.decode(ids, skip_special_tokens=False)))


def test_op10(llm, documents):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [r[:2] for r in documents if r[0] % 4 == 0]  # the brute force of the whole model is slow
    small = llm.createDataFrame(rows, "doc_id bigint, text string")
    from millrace.llm import katz
    close([tuple(r[c] for c in columns) for r in katz.score_documents(small).collect()], brute_katz(rows)[0])
    whole = rows_of(llm, "op10_katz")
    assert len(whole) == len(documents) and all(r.score < 0 and r.base_score < 0 for r in whole)


def test_op8_and_pipeline(llm, documents, items):
    """The pipeline from its stages' brute-force versions, in Python."""
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    model = quality_model.train_quality(table(llm, SF, "documents"), table(llm, SF, "labels"), queries.grade(), 3)
    tail = {d: float(model.tails([model.score(t.encode())])[0][-1]) for d, t, _ in documents}
    graded = {r.doc_id: r for r in rows_of(llm, "op8_quality_model")}
    assert {d: graded[d].kept for d in tail} == {d: p >= queries.LEAST_TAIL for d, p in tail.items()}
    rows = [(d, t) for d, t, _ in documents if tail[d] >= queries.LEAST_TAIL]
    cut = dedup(llm, rows)
    rows = [(d, cut[d]) for d, t in rows if cut[d] == t or cut[d].strip("\n\t\r ")]
    prints = {d: brute_print(t) for d, t in rows}
    groups = brute_groups(prints)
    rows = [(d, t) for d, t in rows if groups[d] == d]
    hits = brute_hits(rows, items)
    rows = [(d, t) for d, t in rows if not hits[d][4]]
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in rows}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(llm, SF).collect()}
    assert got == want
    assert 0 < len(got) < len(documents)


def test_stages_keep_the_columns_of_documents(llm, odd):
    docs = odd.select("doc_id", "text", "source", "n_chars", "fp").withColumnRenamed("fp", "lang")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(llm, docs, SF)
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes
        assert stage(llm, docs.limit(0), SF).collect() == []
    for r in corpus_pipeline.STAGES[1][1](llm, docs, SF).where("text IS NOT NULL").collect():
        assert r.n_chars is None or r.text is not None


def test_stages_decide_by_row(llm, documents, items, monkeypatch):
    """Rows that share an id, or have none, with opposite verdicts."""
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    bench = next(t for _, t in items if len((t or "").split()) > 20)
    shared = "\n".join(f"shared line {i} of a passage" for i in range(12))
    clean, other = "\n".join(f"own line {i}" for i in range(30)), " ".join(f"other{i}" for i in range(90))
    model = quality_model.fit_ordinal([(clean.encode(), 0), (bench.encode(), 0), ((clean + bench).encode(), 1), (other.encode(), 2)] * 5, 3)
    for doc in (None, 7):
        def stage(k, *texts):
            docs = llm.createDataFrame([(doc, t, "en", "s", None if t is None else len(t)) for t in texts], kind)
            return sorted(r.text for r in corpus_pipeline.STAGES[k][1](llm, docs, SF).collect())

        with monkeypatch.context() as m:
            m.setattr(quality_model, "train_quality", lambda *a, **b: model)
            assert stage(0, clean, other, bench) == [other]
        cut = stage(1, shared + "\n" + clean, shared, clean + "\nend")
        assert len(cut) < 3 or min(map(len, cut)) < len(shared)
        assert stage(2, clean, clean, clean, other) == sorted([clean, other])
        assert stage(3, bench, clean, other) == sorted([clean, other])
        rows = llm.createDataFrame([(doc, bench), (doc, clean)], "doc_id bigint, text string")
        left = [r.text for r in corpus_pipeline.decontaminate.decontaminate(rows, table(llm, SF, "benchmark"), action="cut").collect()]
        assert clean in left and bench not in left
