"""First sync of a big table: a key-ordered sweep over several runs, then the cursor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..load import Context
from ..operators import selection
from ..spec import SpecError, cursor_to_json
from .tables import read_table

# The keys of the progress kept in a stream's state.
DONE, LAST_KEY, CURSOR_MAX = "bootstrapped", "bootstrap_last_pk", "bootstrap_cursor_max"
# The ends of the slices still to come, and the highest cursor there was when the sweep began.
ENDS, STARTED_AT = "bootstrap_ends", "bootstrap_cursor_start"
#: Slices that are planned at once; the state holds the keys of as many.
PLANNED = 1000


def read_with_bootstrap(ctx: Context, table: DataFrame, key: Sequence[str], page_rows: int = 5000,
                        max_pages: int = 0) -> DataFrame:
    """The next slice of the sweep, or, once it is complete, the rows past the cursor.

    A run takes ``max_pages`` pages of ``page_rows`` rows (0: all that is left) and leaves its progress in the
    state, which is published with its rows.  The first run plans the ends of all slices (``PLANNED`` at a time)
    in one pass and keeps them in the state, so later ones only read their slice, and read it once.

    Key order says nothing about cursor order, so the highest cursor so far is carried along.  It never passes the
    highest one there was when the sweep began: what changed since, behind the sweep or ahead of it, is read
    again by the first run past the sweep.  A full refresh keeps no state, so it reads the whole table at
    once and leaves the progress of a sweep as it is.
    """
    inc = ctx.spec.incremental
    if inc is None or not key:
        raise SpecError("a bootstrap needs a key and a cursor")
    if ctx.full_refresh:
        return table
    if ctx.state.get(DONE):
        return read_table(table, inc.column, ctx.floor, inc.inclusive)
    last, end, rows = ctx.state.get(LAST_KEY), None, page_rows * max_pages
    rest = selection.after_key(table, key, last)
    if rows:
        ends = ctx.state.pop(ENDS, None)
        if ends is None:
            started = STARTED_AT in ctx.state
            planned, top = selection.sweep_ends(rest, key, rows, PLANNED, None if started else inc.column)
            ends = [[cursor_to_json(v) for v in k] for k in planned]
            if len(ends) < PLANNED:
                ends.append(None)  # the last slice is open
            if not started:
                ctx.state[STARTED_AT] = cursor_to_json(inc.advance(top))
        end = ends.pop(0)
        if ends:
            ctx.state[ENDS] = ends
        ctx.ceiling = ctx.state.get(STARTED_AT)
    ctx.state[LAST_KEY] = end
    ctx.state[DONE] = end is None
    ctx.finish = lambda state, cursor: state.update({CURSOR_MAX: cursor_to_json(cursor)})
    return selection.up_to_key(rest, key, end)
