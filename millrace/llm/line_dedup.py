"""Line dedup: content-defined chunks of lines, and what lies across their ends; what repeats over several lines goes.
DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import drop, settle

#: Lines in the window of the rolling hash, and the share of windows (in so many) that end a chunk.
WINDOW, ENDS, IN = 2, 15, 16
REPORTED = ("n_dropped", "n_dropped_lines")

# A line is what a newline or the end of a sentence ends.  Inside a chunk lines are parted by newlines and end with "N" (a
# newline follows) or "L" (none does), so a line that is "B" can only be a boundary, and cutting and joining are single
# passes over the text, without patterns, however many lines it has.  A text's last line counts as if a newline followed.


def chunk_hash(chunk: Column | str) -> Column:
    return F.xxhash64(chunk)


def _without_end(text: Column, n: int) -> Column:
    """A text without its last ``n`` characters, which are ASCII: cut by bytes, so that none need be counted."""
    return F.substr(text.cast("binary"), F.lit(1), F.octet_length(text) - n).cast("string")


def _bare(line: Column) -> Column:
    """A line without the letter and the blanks at its end: what is hashed and compared."""
    return F.rtrim(_without_end(line, 1))


def _turn(bits: int):
    return lambda h: F.shiftleft(h, bits).bitwiseOR(F.shiftrightunsigned(h, 64 - bits))


def _rolled(hashes: Column, window: int) -> Column:
    """Cyclic polynomial (rotate and xor) over the hashes of each line and the ones before it."""
    out = hashes
    for back in range(1, window):
        turn = _turn(back)
        shifted = F.slice(F.concat(F.array_repeat(F.lit(0).cast("bigint"), back), hashes), F.lit(1), F.size(hashes))
        out = F.zip_with(out, shifted, lambda a, b: a.bitwiseXOR(turn(b)))
    return out


def line_chunks(docs: DataFrame, text_col: str, window: int = WINDOW, ends: int = ENDS, of: int = IN) -> DataFrame:
    """``docs`` with ``__lines``, ``__ends`` (whether a chunk ends with the line) and ``__chunks``: its text cut into
    chunks of lines.

    A chunk ends after a line whose rolling hash is below ``ends`` modulo ``of``, and after the last line.  A boundary
    depends on ``window`` lines alone, so lines put in elsewhere don't shift it.
    """
    # stages refer to a column of the one before twice, so the optimizer doesn't repeat that one inside
    cut = F.concat(F.replace(text_col, F.lit("\n"), F.lit("N\n")), F.lit("N"))
    for end in ". ", "! ", "? ":
        cut = F.replace(cut, F.lit(end), F.lit(end + "L\n"))
    lined = docs.withColumn("__lines", F.split(cut, "\n", -1)).withColumn("__hashes", F.transform("__lines", lambda x: F.xxhash64(x)))
    ended = lined.withColumn("__ends", F.transform(_rolled(F.col("__hashes"), window), lambda h: F.pmod(F.xxhash64(h), F.lit(of)) < ends))
    marked = F.zip_with("__lines", "__ends", lambda line, end: F.concat(line, F.when(end, "\nB").otherwise("")))
    joined = ended.withColumn("__joined", F.array_join(marked, "\n"))
    whole = F.when(F.col("__joined").endswith("\nB"), _without_end(F.col("__joined"), 2)).otherwise(F.col("__joined"))
    return joined.withColumn("__chunks", F.split(whole, "\nB\n", -1)).drop("__hashes", "__joined")


def _where(array: Column | str, holds) -> Column:
    """The places in an array, from 0, of which ``holds`` is true."""
    return F.array_remove(F.transform(array, lambda x, i: F.when(holds(x), i).otherwise(-1)), -1)


def _lasts(chunked: DataFrame) -> DataFrame:
    """``chunked`` with ``__lasts``, the places of the last lines of its chunks."""
    return chunked.withColumn("__lasts", F.array_union(_where("__ends", lambda end: end), F.array(F.size("__ends") - 1)))


def _before(chunk: Column) -> Column:
    """The place of the line before a chunk; -1 before the first."""
    return F.coalesce(F.get("__lasts", chunk - 1), F.lit(-1))


def _passages(chunked: DataFrame, min_lines: int) -> DataFrame:
    """The stretches of lines that are looked up, as ``at`` and the ``hash`` of their lines, one row each: every ``min_lines``
    lines in a row that aren't blank, with the blank ones between them, and chunks that hold more than one such row.

    ``at`` is the first line, the number of lines, and how many blank lines are before and after them.
    """
    blank = F.xxhash64(F.lit(""))
    placed = _lasts(chunked.withColumn("__hashes", F.transform("__lines", lambda x: F.xxhash64(_bare(x))))
                    .withColumn("__solid", _where("__hashes", lambda h: h != blank)))
    n = F.greatest(F.size("__solid") - (min_lines - 1), F.lit(0))
    part = lambda array, start: F.slice(array, F.lit(start + 1), n)
    inner, hashes = [f"line{i}" for i in range(1, min_lines - 1)], [f"hash{i}" for i in range(min_lines)]
    columns = {"before": part(F.concat(F.array(F.lit(-1)), F.col("__solid")), 0),
               "first": part(F.col("__solid"), 0),
               **{name: part(F.col("__solid"), i) for i, name in enumerate(inner, 1)},
               "last": part(F.col("__solid"), min_lines - 1),
               "after": part(F.concat(F.col("__solid"), F.array(F.size("__hashes"))), min_lines),
               **{name: part(F.array_remove("__hashes", blank), i) for i, name in enumerate(hashes)}}
    rows = F.arrays_zip(*[array.alias(name) for name, array in columns.items()])
    # a chunk has the hash of all its lines in place of the first one's, and no blank lines next to it: its rows of lines have them
    lines = lambda last, i: F.slice("__hashes", _before(i) + 2, last - _before(i))
    long = lambda last, i: (last - _before(i) > min_lines) & (F.size(F.filter(lines(last, i), lambda h: h != blank)) > min_lines)
    value = lambda name, last, i: (
        {"before": _before(i), "last": last, "after": last + 1, "hash0": chunk_hash(lines(last, i))}.get(name, _before(i) + 1)
        if name not in hashes[1:] else F.lit(0).cast("bigint"))
    chunks = F.filter(F.transform("__lasts", lambda last, i: F.when(long(last, i), F.struct(
        *[value(name, last, i).alias(name) for name in columns]))), lambda x: x.isNotNull())
    # from an explode that isn't outer Spark infers a filter, which would cut the text once more
    found = (placed.withColumn("__rows", F.concat(rows, chunks)).select("__id", "__key", F.explode_outer("__rows").alias("x"))
             .where("x.first IS NOT NULL").select("__id", "__key", "x.*"))
    first, last = F.col("first"), F.col("last")
    at = F.struct(first.alias("at"), (last - first + 1).alias("n"), (first - F.col("before") - 1).alias("left"), (F.col("after") - last - 1).alias("right"))
    key = F.struct(*hashes, *[F.col(name) - first for name in (*inner, "last")])
    return found.select("__id", "__key", at.alias("at"), chunk_hash(key).alias("hash"))


def _decoded(lines: Column) -> Column:
    """The text of lines, as it stood; only the letter that ends a line is before a newline."""
    whole = F.concat(lines, F.lit("\n"))
    text = F.replace(F.replace(whole, F.lit("L\n"), F.lit("")), F.lit("N\n"), F.lit("\n"))
    return F.when(text.endswith("\n"), _without_end(text, 1)).otherwise(text)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, ends: int = ENDS,
                of: int = IN, min_lines: int = 2, prefix: str = "") -> DataFrame:
    """All columns of ``docs``, with repeated passages taken out of the text, and ``n_dropped`` (chunks of which no line is
    left) and ``n_dropped_lines``, named with ``prefix``; columns of ``docs`` with these names give way.

    Lines end with a newline or a sentence.  A passage is ``min_lines`` lines or more in a row that aren't blank, however short,
    with the blank ones between them.  One that stands at an earlier place too, in another document or its own, goes; the first
    place is that of the smallest id, then text hash, then position.  Looked up are the chunks, and every ``min_lines``
    lines in a row, so that a passage goes wherever the ends of chunks fall in it and whatever its lines stand next to
    elsewhere; blank lines next to it go if they are there in both places.  A line only ever goes for an equal one at an
    earlier place, so of equal lines the first stays.  Lines are equal if their bytes are, but for blanks at their ends;
    hashes only find the candidates.  A text without repeats comes back as it was; a null text stays null; an empty one stays
    empty.  Rows with one id (or none) and one text are the same document and keep the same lines.  An empty table gives
    no rows.  Texts are cut whole, however long, in linear time.

    Hashes are counted first, by partial sums; texts then move by id, to be cut again, and only repeated passages
    move by their bytes, one copy from each task.  Places and hashes are deleted, and shuffle files go,
    as soon as the passages are written.  What is known of each hash is kept in the shared folder, so that the joins of a passage that a third of all documents have can be split.  Positions are gathered by
    document, never by passage.
    """
    names = [c for c in docs.columns if c not in [prefix + r for r in REPORTED]]
    keyed = (docs.select(*names).withColumn("__key", F.xxhash64(text_col)).withColumnRenamed(id_col, "__id")
             .withColumnRenamed(text_col, "__text"))
    # from an explode that isn't outer Spark infers a filter, which would cut the text once more
    made = []
    places = settle(_passages(line_chunks(keyed, "__text", window, ends, of), min_lines), "places", made=made)
    repeated = settle(places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hashes", free=True, made=made)

    def with_places(rows: DataFrame, how: str) -> DataFrame:
        found = rows.groupBy("__id", "__key").agg(F.collect_set("at").alias("__places")).select(
            F.col("__id").alias("__id2"), F.col("__key").alias("__key2"), "__places")
        same = keyed["__id"].eqNullSafe(F.col("__id2")) & (keyed["__key"] == F.col("__key2"))
        rows = keyed.join(found, same, how).drop("__id2", "__key2").withColumn("__cut", F.when(F.col("__places").isNotNull(), F.col("__text")))
        return line_chunks(rows, "__cut", window, ends, of).drop("__cut")

    suspects = with_places(places.join(repeated, "hash", "left_semi"), "inner").withColumn("__bare", F.transform("__lines", _bare))
    texts = F.transform("__places", lambda x: F.struct(x.alias("at"), F.array_join(
        F.slice("__bare", x["at"] + 1, F.least(x["n"], F.size("__bare"))), "\n").alias("text")))
    passages = settle(suspects.select("__id", "__key", F.explode_outer(texts).alias("c"))
                      .select(F.struct("__id", "__key", "c.at.at", "c.at.n").alias("place"), "c.at.left", "c.at.right", "c.text",
                              chunk_hash("c.text").alias("hash")), "passages", free=True)
    drop(docs.sparkSession, made)
    by_bytes = passages.groupBy("hash", "text").agg(F.min(F.struct("place", "left", "right")).alias("first"), F.count("*").alias("n"))
    by_hash = settle(by_bytes.groupBy("hash").agg(F.count("*").alias("texts"), F.min("first").alias("first"),
                                                  F.max("n").alias("n")), "firsts", free=True)
    repeats = passages.drop("text").join(by_hash.where("texts = 1 AND n > 1").select("hash", "first"), "hash")
    unequal = by_hash.where("texts > 1").select("hash")
    if not unequal.isEmpty():  # one hash, several texts: their bytes decide place by place
        known = by_bytes.where("n > 1").select("hash", "text", "first").join(unequal, "hash", "left_semi")
        repeats = repeats.unionByName(passages.join(known, ["hash", "text"]).drop("text"))
    later = repeats.where(F.col("place") != F.col("first.place"))
    dropped = later.select("place.__id", "place.__key", F.struct(
        (F.col("place.at") - F.least("left", "first.left")).alias("first"),
        (F.col("place.at") + F.col("place.n") - 1 + F.least("right", "first.right")).alias("last")).alias("at"))

    # what stays are the lines of no passage that goes
    gone = F.flatten(F.transform("__places", lambda x: F.sequence(x["first"], x["last"])))
    judged = _lasts(with_places(dropped, "left").withColumn("__kept", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), gone)))
    judged = judged.withColumn("__chunk", F.flatten(F.transform("__lasts", lambda last, i: F.array_repeat(i, last - _before(i)))))
    each = lambda column: F.transform("__kept", lambda i: F.get(column, i))
    pieces = judged.withColumns({"__out": F.array_join(each("__lines"), "\n"), "__n_lines": F.size("__lines") - F.size("__kept"),
                                 "__n_chunks": F.array_max("__chunk") + 1 - F.size(F.array_distinct(each("__chunk")))})
    report = [F.coalesce(value, F.lit(0)) for value in ("__n_chunks", "__n_lines")]
    out = F.when(F.col("__places").isNull(), F.col("__text")).otherwise(_decoded(F.col("__out")))
    return pieces.withColumn("__out", out).select(*[F.col({id_col: "__id", text_col: "__out"}.get(c, f"`{c}`")).alias(c) for c in names],
                                                  *[value.alias(prefix + name) for value, name in zip(report, REPORTED)])
