import functools
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import line_dedup
from millrace.llm.line_dedup import dedup_lines, line_chunks


def chunks_of(llm, text):
    return llm.createDataFrame([(text,)], "t string").transform(lambda d: line_chunks(d, "t")).first()["__chunks"]


def plain(chunk):
    """Lines of a chunk with what ends them."""
    return [line[:-1] + ("\n" if line[-1] == "N" else "") for line in chunk.split("\n")]


def bare(line):
    return line.rstrip("\n").rstrip(" ")


def shared(a, b):
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def brute(rows, chunked):
    """Chunks that occur at an earlier place go, with the equal lines next to them, if that makes two lines that aren't blank."""
    first, gone = {}, {}
    for doc, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0])):
        chunks = [[bare(x) for x in c] for c in chunked[text]]
        near = lambda p: chunks[p] if 0 <= p < len(chunks) else []  # noqa: B023
        for at, chunk in enumerate(chunks):
            coded = "\n".join(x.removesuffix("\n") + "NL"[not x.endswith("\n")] for x in chunked[text][at])
            if sum(x != "" for x in chunk) < 2 and len(coded) <= 24:
                continue
            before, after = near(at - 1)[::-1], near(at + 1)
            same = coded[:-1].rstrip(" ")
            if same not in first:
                first[same] = before, after
                continue
            left, right = shared(before, first[same][0]), shared(after, first[same][1])
            if sum(x != "" for x in chunk + before[:left] + after[:right]) < 2:
                continue
            at_line = sum(len(c) for c in chunks[:at])
            gone.setdefault((doc, text), set()).update(range(at_line - left, at_line + len(chunk) + right))
    out = []
    for doc, text in rows:
        if text is None or (doc, text) not in gone:
            out.append((doc, text))
            continue
        lines = [line for c in chunked[text] for line in c]
        left = "".join(line for i, line in enumerate(lines) if i not in gone[doc, text])
        out.append((doc, left.removesuffix("\n")))
    return out


def test_chunks_put_the_text_together_again(llm):
    for text in ["", "a", "\n", "a\n", "\n\na\nB\nL\nLL\n\n", "B\nB", "x\ny\n" * 50, "L\nB\n", "One. Two! Three? \n. . .", "N. L. B. ", "a.  b"]:
        assert "".join(line for c in chunks_of(llm, text) for line in plain(c)) == text + "\n"


def test_boundaries_resist_shifts(llm):
    rng = random.Random(3)
    lines = [f"line {rng.random()}" for _ in range(200)]
    one = {c for c in chunks_of(llm, "\n".join(lines))}
    two = {c for c in chunks_of(llm, "\n".join(["new"] + lines[:100] + ["another new one"] + lines[100:]))}
    assert len(one & two) >= len(one) - 6


def test_against_brute_force(llm):
    rng = random.Random(4)
    passage = [f"shared line {i} of the passage" for i in range(12)]
    rows = []
    for doc in range(60):
        lines = [f"own line {rng.random()}" for _ in range(rng.randint(0, 8))]
        if doc % 3 == 0:
            at = rng.randint(0, len(lines))
            lines[at:at] = passage
        if doc % 7 == 0:
            lines += lines[:5]
        rows.append((doc, "\n".join(lines)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (101, None), (102, ""), (103, "\n\n\n"), (104, "\n\n\n")]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    chunked = {t: [plain(c) for c in chunks_of(llm, t)] for t in {t for _, t in rows if t is not None}}
    got = [(r.doc_id, r.text) for r in dedup_lines(docs).collect()]
    want = brute(rows, chunked)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(len(t or "") for _, t in got) < sum(len(t or "") for _, t in rows)
    assert "shared line 5 of the passage" in dict(got)[0]


def test_equal_hashes_of_unequal_chunks(llm, monkeypatch):
    """With hashes of two bits nearly all chunks collide; their bytes decide."""
    rows = [(i, "\n".join(f"a line of some length {(i * k) % 17} of {k}" for k in range(12))) for i in range(25)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    chunked = {t: [plain(c) for c in chunks_of(llm, t)] for _, t in rows}
    want = sorted(brute(rows, chunked))
    whole = F.xxhash64
    monkeypatch.setattr(line_dedup, "chunk_hash", lambda c: F.pmod(whole(c), F.lit(4)))
    got = sorted((r.doc_id, r.text) for r in dedup_lines(docs).collect())
    assert got == want and got != sorted(rows)


def test_a_long_text_takes_linear_time(llm):
    text = "\n".join(f"row {i % 5000} {i // 5000 % 2}" for i in range(100_000))
    row = dedup_lines(llm.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.n_dropped > 1000 and len(row.text) < len(text)


def test_odd_rows(llm, odd, empty):
    got = dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_dropped", "n_dropped_lines"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert sum(r.text is None for r in rows) == 2 and {r.n_dropped for r in rows if r.text is None} == {0}
    assert dedup_lines(empty).collect() == []


def test_no_python_on_the_path(llm, odd):
    plan = dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("lines, sentences", [(3, 1), (5, 1), (12, 1), (40, 1), (1, 6), (2, 4)])
def test_planted_passages_go_but_for_their_first_place(llm, lines, sentences):
    """Passages at random places of otherwise different documents: nine tenths of the later copies' lines go, nothing else."""
    rng = random.Random(lines * 10 + sentences)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(8, 12))) + "."
    passages = [[" ".join(sentence() for _ in range(sentences)) for _ in range(lines)] for _ in range(60)]
    rows, own = [], {}
    for doc in range(120):
        mine = [sentence() for _ in range(rng.randint(4, 12))]
        at = rng.randint(0, len(mine))
        rows.append((doc, "\n".join(mine[:at] + passages[doc % 60] + mine[at:])))
        own[doc] = mine
    got = dict((r.doc_id, r.text) for r in dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert all(got[doc] == text for doc, text in rows[:60])
    assert all(line in got[doc].split("\n") or any(line in x for x in got[doc].split("\n")) for doc, mine in own.items() for line in mine)
    left = sum(s in got[60 + i] for i, p in enumerate(passages) for line in p for s in line.split(". "))
    total = sum(len(line.split(". ")) for p in passages for line in p)
    print(f"{lines} lines of {sentences} sentences: {1 - left / total:.2f} removed")
    assert left <= 0.1 * total


def test_columns_with_clashing_names(llm):
    docs = llm.createDataFrame([(1, "a b c d e f g h i j.\nk l m n o p q r s.", 7, 8, 9)], "doc_id bigint, text string, n_dropped int, n_chunks int, other int")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_chunks", "other", "n_dropped", "n_dropped_lines"] and out.first().other == 9
    assert dedup_lines(docs, prefix="__").columns == [*docs.columns, "__n_dropped", "__n_dropped_lines"]


def test_the_stage_filters_texts_that_are_made_once(llm):
    """What makes the new text isn't repeated in the filter on it."""
    twice = "one line that is long enough\nand another one that is long enough\n"
    rows = [(1, twice), (2, twice), (3, "something else\n"), (4, ""), (5, None)]
    out = corpus_pipeline.dedup_lines(llm, llm.createDataFrame(rows, "doc_id bigint, text string"), "")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "transform(" not in plan
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, twice), (3, "something else\n"), (4, ""), (5, None)]


def test_ends_are_cut_by_bytes(llm):
    texts = ["", "L", "N", "é  N", "日本 L", "a\nbN", " N", "x\U0001F600L", None]
    rows = llm.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", line_dedup._without_end(F.col("t"), 1), line_dedup._bare(F.col("t"))).collect()
    assert {r[0]: r[1:] for r in rows} == {i: (t and t[:-1], t and t[:-1].rstrip(" ")) if t is not None else (None, None) for i, t in enumerate(texts)}
    plan = llm.createDataFrame([("a",)], "t string").select(line_dedup._bare(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and " length(" not in plan


def lines_of(text):
    return re.split(r"(?<=\n)|(?<=[.!?] )", text + "\n")[:-1]


def whole_passages(rows, min_lines=2):
    """Every row of ``min_lines`` lines that aren't blank and stand at an earlier place too goes, with the blank lines between them and
    those next to them that are there in both places."""
    first, gone = {}, {}
    for doc, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0])):
        lines = [bare(x) for x in lines_of(text)]
        solid = [-1, *[i for i, x in enumerate(lines) if x], len(lines)]
        for t in range(1, len(solid) - min_lines):
            a, b = solid[t], solid[t + min_lines - 1]
            left, right = a - solid[t - 1] - 1, solid[t + min_lines] - b - 1
            there = first.setdefault(tuple(lines[a:b + 1]), (doc, text, a, left, right))
            if there[:3] != (doc, text, a):
                gone.setdefault((doc, text), set()).update(range(a - min(left, there[3]), b + 1 + min(right, there[4])))
    out = []
    for doc, text in rows:
        lost = gone.get((doc, text), ())
        kept = text if not lost else "".join(x for i, x in enumerate(lines_of(text)) if i not in lost).removesuffix("\n")
        out.append((doc, kept, len(lost)))
    return sorted(out, key=str)


def all_of(df):
    return sorted(((r.doc_id, r.text, r.n_dropped_lines) for r in df.collect()), key=str)


def test_passages_of_short_lines_go(llm):
    """However short its lines are, a passage goes, whole."""
    listed = "eggs\nmilk\nbread\nsalt\nrice\ntea"
    rows = [(1, listed), (2, "to buy:\n" + listed + "\nthat is all"), (3, "Yes. No. Why? So. Go!"), (4, "He said: Yes. No. Why? So. Go! ")]
    got = {r.doc_id: r for r in dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d: r.text for d, r in got.items()} == {1: listed, 2: "to buy:\nthat is all", 3: rows[2][1], 4: "He said: Yes. "}
    assert {d: r.n_dropped_lines for d, r in got.items()} == {1: 0, 2: 6, 3: 0, 4: 4} and got[2].n_dropped > 0


def test_a_passage_goes_though_its_lines_stood_elsewhere_before(llm):
    """The first place of each line says nothing of the passage."""
    one, two = "one line that is long enough to be a chunk", "another line that is long enough to be one"
    rows = [(1, f"{one}\nx1"), (2, f"y1\n{two}"), (3, f"x3\n{one}\n{two}\ny3"), (4, f"x4\n{one}\n{two}\ny4")]
    got = {r.doc_id: r.text for r in dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {**dict(rows), 4: "x4\ny4"}


def test_a_passage_goes_with_its_blank_lines(llm):
    parts = [f"paragraph {i} is a single line of some length" for i in range(8)]
    rows = [(1, "\n\n".join(parts)), (2, "own\n\n" + "\n\n".join(parts) + "\n\nown too"), (3, "\n\n\n".join(parts))]
    got = {r.doc_id: r.text for r in dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: rows[0][1], 2: "own\n\n\nown too", 3: rows[2][1]}


@pytest.mark.parametrize("min_lines, ends", [(1, 15), (2, 15), (3, 15), (4, 15), (2, 0), (2, 16)])
def test_against_brute_force_of_whole_passages(llm, min_lines, ends):
    """Whatever the chunks are: with no ends a text is one, with 16 of 16 each line."""
    rng = random.Random(min_lines)
    some = ["", "", "a", "b ", "is. ", "Go! Why? ", "a line that has more than a few characters", "another such line. And one more. ", "\u00e9t\u00e9", "N", "L", "B"]
    rows = [(doc if doc % 9 else None, "\n".join(rng.choice(some) if rng.random() < 0.7 else f"own {doc} {i}" for i in range(rng.randint(0, 25))))
            for doc in range(1, 60)]
    rows += [rows[5], (200, rows[7][1]), (201, None), (202, ""), (203, "\n\n\n"), (204, "\n\n\n"), (None, None)]
    rows = [r for i, r in enumerate(rows) if r[0] is not None or i < 10 or r[1] is None]  # one text without an id: their order is that of hashes
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    got, want = all_of(dedup_lines(docs, min_lines=min_lines, ends=ends)), whole_passages(rows, min_lines)
    assert got == want and sum(r[2] for r in want) > 50


def test_a_long_text_of_short_lines_takes_linear_time(llm):
    """Whichever columns are asked for, no array is made once for each line."""
    text = "\n".join(f"{i % 5000}" for i in range(60_000))
    out = dedup_lines(llm.createDataFrame([(1, text)], "doc_id bigint, text string"))
    kept = "\n".join(f"{i}" for i in range(5000))
    assert out.first().text == kept and out.select("text").first().text == kept
    assert out.select("n_dropped_lines").first().n_dropped_lines == 55_000 and out.select("n_dropped").first().n_dropped > 50_000


def test_the_stage_counts_characters_where_no_whole_chunk_went(llm, monkeypatch):
    monkeypatch.setattr(line_dedup, "dedup_lines", functools.partial(dedup_lines, ends=0))
    rows = [(1, "own one\nshared a\nshared b\nown two", 33), (2, "own three\nshared a\nshared b\nown four", 36)]
    out = corpus_pipeline.dedup_lines(llm, llm.createDataFrame(rows, "doc_id bigint, text string, n_chars int"), "")
    assert sorted(map(tuple, out.collect())) == [rows[0], (2, "own three\nown four", 18)]
