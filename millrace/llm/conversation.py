"""Conversation structure repair: turns aligned with every feasible length of the alternating grammar."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_schema, map_batches, settle

# What edits cost, and their initials in ASCII order.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"

#: Turns that are aligned at once; longer conversations are stretches of as many, put together exactly.
BLOCK = 16
#: Turns of a conversation that one task holds; longer ones are dealt to tasks by stretches.
WHOLE = 4096
#: Where in the grammar a stretch begins and ends: nothing yet, after s, a user's turn next, an assistant's next.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: A conversation may end with nothing or after an assistant.
FINAL = (BEGIN, USER)
_FAR = 1 << 60


def turn_code(role: str, fault: str) -> str:
    """One letter for what alignment sees of a turn: # must go, capitals are cut off, ? is no role of the grammar."""
    if fault in ("blank", "duplicate"):
        return "#"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
    return {"?": "!"}.get(initial, initial.upper()) if fault == "truncated" else initial


def _targets(enter: int, leave: int, most: int) -> Iterator[str]:
    """Every string of the grammar of ``most`` letters or fewer that leads from one place to another."""
    for lead in ("", "s") if enter == BEGIN else ("",):
        for m in range(most + 1 - len(lead)):
            letters = "au" if enter == ASSISTANT else "ua"
            target = lead + (letters * (m // 2 + 1))[:m]
            end = enter if not target else SYSTEM if target == "s" else ASSISTANT if target[-1] == "u" else USER
            if end == leave:
                yield target


def _offset(x: int) -> int:
    return INSERT * x if x > 0 else -DELETE * x


def wagner_fischer(codes: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits that turn ``codes`` into ``target``, of equal ones the least audit; none
    if they cost more than ``limit``.

    Cells (i, j) hold the cost of the rest.  Ukkonen's band: a path over a cell pays for its distance from both
    corners' diagonals, so cells where that is over the limit are left out.
    """
    n, m = len(codes), len(target)
    apart = m - n
    if _offset(apart) > limit:
        return None
    low = high = min(0, apart)
    while _offset(low - 1) + _offset(apart - low + 1) <= limit and low > -n:
        low -= 1
    while _offset(high + 1) + _offset(apart - high - 1) <= limit and high < m:
        high += 1
    cost = [[_FAR] * (m + 2) for _ in range(n + 2)]
    cost[n][m] = 0
    for i in range(n, -1, -1):
        row, below = cost[i], cost[i + 1]
        code = codes[i] if i < n else "#"
        extra = CUT if code.isupper() or code == "!" else 0
        initial = code.lower()
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = row[j]
            if i < n:
                best = min(best, DELETE + below[j])
                if j < m and code != "#":
                    if initial == target[j]:
                        best = min(best, KEEP + extra + below[j + 1])
                    elif target[j] != "s":
                        best = min(best, REROLE + extra + below[j + 1])
            if j < m and target[j] != "s":
                best = min(best, INSERT + row[j + 1])
            row[j] = best
    whole = cost[0][0]
    if whole > limit or whole >= _FAR:
        return None
    audit, i, j = [], 0, 0
    while (i, j) != (n, m):  # the first of D, I, K, R that costs no more
        here, code = cost[i][j], codes[i] if i < n else "#"
        if i < n and DELETE + cost[i + 1][j] == here:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and INSERT + cost[i][j + 1] == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if code.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return whole, "".join(audit)


@lru_cache(1 << 15)
def align(codes: str, enter: int, leave: int) -> tuple[int, str] | None:
    """The cheapest edits of a stretch over all feasible targets, of equal ones the least audit."""
    gone = codes.count("#")
    stay = len(codes) - gone
    targets = sorted((DELETE * gone + _offset(len(t) - stay), t) for t in _targets(enter, leave, 2 * len(codes) + 3))
    best: tuple[int, str] | None = None
    for least, target in targets:
        if best is not None and least > best[0]:
            break
        found = wagner_fischer(codes, target, _FAR - 1 if best is None else best[0])
        if found is not None and (best is None or found < best):
            best = found
    return best


Moves = dict[tuple[int, int], tuple[int, str]]


def moves(codes: str) -> Moves:
    """Cost and audit of a stretch between any two places of the grammar."""
    found = {(e, l): align(codes, e, l) for e in range(4) for l in range(4)}
    return {k: v for k, v in found.items() if v is not None}


def then(a: Moves, b: Moves) -> Moves:
    """Both stretches.  Of audits between the same two places, one that begins another costs less, so among those
    that cost the same the least of both parts gives the least of the whole."""
    out: Moves = {}
    for (enter, mid), (cost, audit) in a.items():
        for (middle, leave), (more, rest) in b.items():
            if mid == middle:
                whole = cost + more, audit + rest
                if (enter, leave) not in out or whole < out[enter, leave]:
                    out[enter, leave] = whole
    return out


def repair(codes: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if len(codes) <= BLOCK:
        ends = {BEGIN: align(codes, BEGIN, BEGIN), USER: align(codes, BEGIN, USER)}
    else:
        ends = {BEGIN: (0, "")}
        for at in range(0, len(codes), BLOCK):
            stretch = moves(codes[at:at + BLOCK])
            ends = {leave: v for (_, leave), v in then({(BEGIN, p): v for p, v in ends.items()}, stretch).items()}
    return min(v for place, v in ends.items() if place in FINAL and v is not None)


def repaired(codes: str, audit: str, turns: list[tuple[str, str]], enter: int = BEGIN) -> tuple[list[tuple[str, str]], int]:
    """The turns (role, text) that an audit leaves of a stretch, and its place in the grammar at the end."""
    out, i, place = [], 0, enter
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        letter = codes[i].lower() if edit == "K" else "a" if place == ASSISTANT else "u"
        out.append(turns[i] if edit == "K" else (ROLES[letter], turns[i][1] if edit == "R" else ""))
        place = {"s": SYSTEM, "u": ASSISTANT, "a": USER}[letter]
        i += edit != "I"
    return out, place


def lines(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def text_fault(text: str) -> str:
    last = text.rstrip(BLANKS)[-1:]
    return "blank" if not last else "" if last in ENDS else "truncated"


FAULTS = ("blank", "duplicate", "truncated")
REPORT = "{} {}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _report(turns: list[tuple], with_text: bool) -> dict:
    """The report of one conversation from its (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in turns:
        fault = text_fault(text)
        faults.append(fault if fault == "blank" else "duplicate" if (role, text) in seen else fault)
        seen.add((role, text))
    numbers = {t for t, _, _ in turns if t is not None}
    codes = "".join(turn_code(role, fault) for (_, role, _), fault in zip(turns, faults))
    cost, audit = repair(codes)
    left, _ = repaired(codes, audit, [t[1:] for t in turns])
    text = lines(left)
    return {"gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, **{f: faults.count(f) for f in FAULTS},
            "illegal": _illegal([role[:1] for _, role, _ in turns]), "cost": cost, "audit": audit, "repaired": text if with_text else None,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _rows_in_order(rows: DataFrame, make, schema: str) -> DataFrame:
    """``make(id, rows)`` gives the output row (a dict) of all rows (dicts) that share ``conv``.  Rows of an id come to one
    task in order, a batch at a time; ``rows`` is an iterator."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in batch.to_pylist())
        row, out = next(stream, None), []
        while row is not None:
            conv, following = row["conv"], None

            def group(first):
                nonlocal following
                yield first
                for other in stream:
                    if other["conv"] != conv:
                        following = other
                        return
                    yield other

            members = group(row)
            out.append({**make(members), "conv": conv})
            for _ in members:
                pass
            row = following
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def _whole(rows: DataFrame, id_type: str, with_text: bool) -> DataFrame:
    def report(members):
        return _report([(r["turn"], r["role"], r["text"]) for r in members if r["present"]], with_text)

    placed = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    return _rows_in_order(placed, report, REPORT.format("conv", id_type) + ", repaired string, repaired_sha256 string")


STRETCH = "rows bigint, first string, last string, illegal bigint, moves array<struct<enter: int, leave: int, cost: bigint, audit: string>>"


def _matrix(stretch: dict) -> Moves:
    return {(m["enter"], m["leave"]): (m["cost"], m["audit"]) for m in stretch["moves"]}


def _rows(found: Moves) -> list[dict]:
    return [dict(enter=e, leave=l, cost=c, audit=a) for (e, l), (c, a) in found.items()]


def fold(stretches: list[dict]) -> dict:
    """Stretches that follow each other, as one."""
    out = {**stretches[0], "moves": _matrix(stretches[0])}
    for s in stretches[1:]:
        out = {"rows": out["rows"] + s["rows"], "first": out["first"], "last": s["last"],
               "illegal": out["illegal"] + s["illegal"] + (out["last"] + s["first"] not in LEGAL),
               "moves": then(out["moves"], _matrix(s))}
    return {**out, "moves": _rows(out["moves"])}


def route(stretches: list[dict], enter: int, leave: int) -> list[tuple[int, int]]:
    """Where the cheapest edits (of equal ones, those of the least audit) enter and leave each stretch."""
    ends, back = {enter: (0, "")}, []
    for s in stretches:
        step: dict[int, tuple[int, str]] = {}
        came: dict[int, int] = {}
        for (a, b), (cost, audit) in _matrix(s).items():
            if a in ends:
                whole = ends[a][0] + cost, ends[a][1] + audit
                if b not in step or whole < step[b]:
                    step[b], came[b] = whole, a
        ends = step
        back.append(came)
    out = []
    for came in reversed(back):
        out.append((came[leave], leave))
        leave = came[leave]
    return out[::-1]


def _align_blocks(batch: dict) -> dict:
    out = []
    for turns in batch["turns"]:
        initials = [t["initial"] for t in turns]
        codes = "".join(turn_code(t["initial"], t["fault"]) for t in turns)
        out.append(dict(rows=len(turns), first=initials[0], last=initials[-1], illegal=_illegal(initials), moves=_rows(moves(codes))))
    return {"key": batch["key"], "block": batch["block"], "stretch": out}


def _fold_parts(batch: dict) -> dict:
    return {"key": batch["key"], "part": batch["part"],
            "stretch": [fold([s["stretch"] for s in group]) for group in batch["stretches"]]}


def _finish(batch: dict) -> dict:
    out = {"key": batch["key"], "illegal": [], "cost": [], "audit": [], "ways": []}
    for group in batch["stretches"]:
        stretches = [s["stretch"] for s in group]
        whole = fold(stretches)
        cost, audit, leave = min((c, a, l) for (e, l), (c, a) in _matrix(whole).items() if e == BEGIN and l in FINAL)
        out["illegal"].append(whole["illegal"])
        out["cost"].append(cost)
        out["audit"].append(audit)
        out["ways"].append([dict(part=s["at"], enter=e, leave=l) for s, (e, l) in zip(group, route(stretches, BEGIN, leave))])
    return out


def _share_out(batch: dict) -> dict:
    out = {"key": [], "block": [], "enter": [], "audit": []}
    for key, group, enter, leave in zip(batch["key"], batch["stretches"], batch["enter"], batch["leave"]):
        for s, way in zip(group, route([s["stretch"] for s in group], enter, leave)):
            out["key"].append(key)
            out["block"].append(s["at"])
            out["enter"].append(way[0])
            out["audit"].append(_matrix(s["stretch"])[way][1])
    return out


def _apply_blocks(batch: dict) -> dict:
    texts = []
    for turns, enter, audit in zip(batch["turns"], batch["enter"], batch["audit"]):
        codes = "".join(turn_code(t["role"], t["fault"]) for t in turns)
        texts.append(lines(repaired(codes, audit, [(t["role"], t["text"]) for t in turns], enter)[0]))
    return {"conv": [k["conv"] for k in batch["key"]], "block": batch["block"], "text": texts}


def _digest(with_text: bool):
    def work(members):
        digest, empty, kept = hashlib.sha256(), True, []
        for row in members:
            if row["text"]:  # a turn that is left has a colon at least
                piece = row["text"] if empty else "\n" + row["text"]
                digest.update(piece.encode())
                kept += [piece] if with_text else []
                empty = False
        return {"repaired": "".join(kept) if with_text else None, "repaired_sha256": digest.hexdigest()}
    return work


def _long(rows: DataFrame, id_type: str, with_text: bool) -> DataFrame:
    """Reports of conversations too long for one task: their turns are range-partitioned in order, aligned by stretches
    of ``BLOCK`` and put together in two steps, then each stretch's share of the way is handed back to its turns.
    Only the digest of what is left, which is sequential by nature, passes one task, a stretch at a time."""
    key_type, stretch = f"key struct<conv: {id_type}>", f"stretch struct<{STRETCH}>"
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "copy"]
    number = F.monotonically_increasing_id()  # ascends with the place of a row in its part
    ordered = (rows.where("present").withColumn("copy", number).repartitionByRange(*order).sortWithinPartitions(*order)
               .select(F.struct("conv").alias("key"), "turn", "role", "text", number.alias("at")))
    ordered = settle(ordered.withColumn("same", F.sha2(F.concat_ws("\x00", "role", "text"), 256)), "turns")
    copies = ordered.groupBy("key", "same").agg(F.min("at").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = (F.when(~F.col("text").rlike(f"[^{BLANKS}]"), "blank").when(F.col("original") < F.col("at"), "duplicate")
             .when(~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z"), "truncated").otherwise(""))
    judged = settle(ordered.join(copies, ["key", "same"], "left").select(
        "key", "turn", "at", F.expr(f"at div {BLOCK}").alias("block"), "role", "text", fault.alias("fault")), "faults")

    def by_block(*columns) -> DataFrame:
        return judged.groupBy("key", "block").agg(F.array_sort(F.collect_list(F.struct("at", *columns))).alias("turns"))

    def gathered(stretches: DataFrame, at: str, *keys: str) -> DataFrame:
        return stretches.groupBy("key", *keys).agg(
            F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), "stretch"))).alias("stretches"))

    blocks = settle(map_batches(by_block(F.substring("role", 1, 1).alias("initial"), "fault"), lambda: _align_blocks,
                                f"{key_type}, block bigint, {stretch}")
                    .withColumn("part", F.expr(f"block div {(1 << 33) // BLOCK}")), "blocks")
    parts = settle(map_batches(gathered(blocks, "block", "part"), lambda: _fold_parts, f"{key_type}, part bigint, {stretch}"), "parts")
    wholes = settle(map_batches(gathered(parts, "part"), lambda: _finish, f"{key_type}, illegal bigint, cost bigint, "
                                "audit string, ways array<struct<part: bigint, enter: int, leave: int>>"), "wholes")
    ways = wholes.select("key", F.inline("ways"))
    audits = settle(map_batches(gathered(blocks, "block", "part").join(ways, ["key", "part"]), lambda: _share_out,
                                f"{key_type}, block bigint, enter int, audit string"), "audits")
    pieces = map_batches(by_block("role", "text", "fault").join(audits, ["key", "block"]), lambda: _apply_blocks,
                         f"conv {id_type}, block bigint, text string")
    digests = _rows_in_order(pieces.repartition("conv").sortWithinPartitions("conv", "block"), _digest(with_text),
                             f"conv {id_type}, repaired string, repaired_sha256 string")
    counts = judged.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS])
    return (counts.join(wholes, "key").join(digests.select(F.struct("conv").alias("key"), "repaired", "repaired_sha256"), "key")
            .select("key.conv", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired", "repaired_sha256"))


def repair_conversations(turns: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", whole: int = WHOLE, with_text: bool = False) -> DataFrame:
    """One row per conversation: faults, the cheapest repair and a digest of what it leaves.

    Turns are taken by number, nulls first, then role and text; a null role or text is one space.  A turn is blank,
    a duplicate (role and text seen earlier) or truncated (no ``.!?`` at its end), the first that holds; ``gaps`` are
    numbers that no turn has; ``illegal`` counts neighbours that aren't system-user, user-assistant or
    assistant-user.  ``audit`` has the initials of the cheapest edits (keep, rerole, delete, insert) after which roles
    read ``(s?(ua)+)?``, of equal ones the ASCII-least, ``cost`` their cost, ``repaired_sha256`` the digest of the
    ``role:text`` lines that are left, and ``repaired`` these lines with ``with_text`` (a whole conversation in a
    row).  ``ids`` adds conversations without any turn: zeros, an empty audit and the digest of nothing.  A null id is
    a conversation like any other; repeated turns are duplicates; an empty table gives no rows; other columns are
    left out.  Role and text are taken whole, however long.

    Conversations of up to ``whole`` turns are read in order by the task of their id, one at a time; longer ones go by
    stretches (``_long``), to the same result.
    """
    id_type = dict(turns.dtypes)[conv_col]
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), space(role_col).alias("role"),
                        space(text_col).alias("text"), F.lit(True).alias("present"))
    if ids is not None:
        known = ids.select(F.col(conv_col).alias("conv")).distinct()
        rows = rows.unionByName(known.withColumn("present", F.lit(False)), allowMissingColumns=True)
    long = settle(turns.groupBy(F.col(conv_col).alias("long")).count().where(F.col("count") > whole).select("long"), "long")
    if long.isEmpty():
        out = _whole(rows, id_type, with_text)
    else:
        is_long = F.col("conv").eqNullSafe(F.col("long"))
        out = _whole(rows.join(long, is_long, "left_anti"), id_type, with_text).unionByName(
            _long(rows.join(long, is_long, "left_semi"), id_type, with_text))
    return out.withColumnRenamed("conv", conv_col).select(
        conv_col, "gaps", *FAULTS, "illegal", "cost", "audit", *(["repaired"] if with_text else []), "repaired_sha256")
