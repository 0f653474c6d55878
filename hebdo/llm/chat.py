"""Chat formatting in budgeted windows.

A turn is written as ``### role:``, a line break, its text and ``</turn>``
with a line break.  Backslashes and the two control strings inside texts and
roles are escaped with backslash codes, so no text can open or close a turn
and reading back restores it exactly.

Prefix sums of the turns' tokens cut a conversation into turn-aligned spans:
a window holds the system turn (if the first turn has that role), the turns
before the span that fit into ``history`` tokens, and the span, which ends
before the window would pass ``budget``.  A turn that is larger than what is
left of an empty window has a window of its own.  The loss mask of a window
marks the escaped texts of the span's assistant turns; repeated turns are
never marked, so each assistant text is a target once.

Turns are rows: a window function numbers them, and the texts stay rows until a
window is joined.  Only the token counts of a conversation are put into one
array, for the running sum that cuts spans starts anew at each of them; the
windows that a turn belongs to are joined back by its number.  ``window_rows``
never holds a conversation's texts together; ``windows``, ``read_back`` and
``digest`` put a conversation's windows into one row, because they return or
hash the whole of it.

Only built-in column expressions are used.

Cases: null texts are empty, null roles too; turns of one number are ordered
by role and text, null turn numbers come first; repeated rows stay as turns;
a row without a conversation id belongs to no other: it is a conversation of
one turn, so a table of such rows makes no group; other columns are
ignored; an empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
TURN_TOKENS = 4                 # of the marks around a text
SYSTEM, TARGET = "system", "assistant"
_OPEN, _CLOSE = "### ", "</turn>"

#: code after a backslash -> what it stands for (the backslash itself first)
_CODES = (("\\", "\\"), ("h", _OPEN), ("e", _CLOSE), ("n", "\n"))


def escaped(text: Column, role: bool = False) -> Column:
    """Text without control strings; a role has no line break either."""
    for code, plain in _CODES[:4 if role else 3]:
        text = F.replace(text, F.lit(plain), F.lit("\\" + code))
    return text


def _unescape(text: str) -> str:
    """SQL that restores the escaped SQL expression ``text``."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("\n", "\\n").replace("'", "\\'") + "'"
    # doubled backslashes split first: what is left of a backslash in a part starts a code
    part = "p"
    for code, plain in _CODES[1:]:
        part = f"replace({part}, {quote(chr(92) + code)}, {quote(plain)})"
    return f"array_join(transform(split({text}, {quote(chr(92) * 4)}), p -> {part}), {quote(chr(92))})"


def _said(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in the last two."""
    r, x = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), x.alias("text"))


def _written(said: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and each turn's marks: f is the turn as written, h and b the characters of head and body."""
    tokens = F.size(F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")) + TURN_TOKENS
    head = F.concat(F.lit(_OPEN), escaped(F.col("role"), role=True), F.lit(":\n"))
    made = said.select(*keys, (F.col("role") == TARGET).alias("target"), (F.col("role") == SYSTEM).alias("system"),
                       tokens.cast("long").alias("tokens"), head.alias("head"), escaped(F.col("text")).alias("body"))
    return made.select(*keys, "target", "system", "tokens", F.concat("head", "body", F.lit(_CLOSE + "\n")).alias("f"),
                       F.char_length("head").cast("long").alias("h"), F.char_length("body").cast("long").alias("b"))


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """(conv_id, i, target, system, tokens, f, h, b): each turn of a conversation with its number from 0."""
    said = _said(rows.where(F.col(conv).isNotNull()), conv, turn, role, text)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return _written(said.withColumn("i", F.row_number().over(order) - 1), "conv_id", "i")


def spans(t: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, s, e, h, sys): the span s..e - 1 of each window, the first turn of its history, and
    whether the conversation begins with a system turn (1 or 0).  ``t`` is what ``turns`` gives."""
    k = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "tokens", "system"))).alias("k"))
    k = k.select("conv_id", F.expr("transform(k, x -> x.tokens)").alias("k"),
                 F.when(F.col("k")[0]["system"], 1).otherwise(0).alias("sys"))
    k = k.withColumn("room", F.expr(f"greatest(1L, {budget - history} - case when sys = 1 then k[0] else 0L end)"))
    # span starts, by running over the token counts; the state is small and grows with the spans only
    k = k.select("conv_id", "sys", "k", F.expr(
        "aggregate(transform(k, (x, i) -> struct(cast(i as int) as i, if(i < sys, 0L, x) as k)), "
        "struct(array(0) as starts, 0L as used), (a, x) -> if(a.used > 0 and a.used + x.k > room, "
        "struct(concat(a.starts, array(x.i)) as starts, x.k as used), "
        "struct(a.starts as starts, a.used + x.k as used)), a -> a.starts)").alias("starts"))
    # the turns before a span that fit into the history: each has TURN_TOKENS tokens at least
    reach = history // TURN_TOKENS
    k = k.select("conv_id", "sys", F.expr(
        f"transform(starts, (s, w) -> struct(w as window, s as s, if(w + 1 < size(starts), starts[w + 1], size(k)) as e, "
        f"if(s = 0, 0, s - aggregate(if(s > greatest(sys, s - {reach}), "
        f"reverse(slice(k, greatest(sys, s - {reach}) + 1, s - greatest(sys, s - {reach}))), "
        f"slice(k, 1, 0)), struct(0 as n, 0L as k, true as go), (a, x) -> "
        f"if(a.go and a.k + x <= {history}, struct(a.n + 1 as n, a.k + x as k, true as go), "
        f"struct(a.n as n, a.k as k, false as go)), a -> a.n)) as h))").alias("spans"))
    # outer: there is always a span, and no test for one is pushed down into the expressions above
    return k.select("conv_id", "sys", F.inline_outer("spans"))


_ROW = "conv_id", "window", "text", "repeated", "loss"


def _joined(v: DataFrame, *keys: str) -> DataFrame:
    """The turns ``v`` of each window (in order, ``repeated`` of them seen before) as its text and loss mask."""
    return v.select(*keys, F.expr("array_join(transform(v, x -> x.f), '')").alias("text"), "repeated", F.expr(
        "aggregate(v, struct(0L as at, 0 as i, slice(array(struct(0L as start, 0L as length)), 1, 0) as m), "
        "(a, x) -> struct(a.at + x.h + x.b + 8 as at, a.i + 1 as i, if(x.target and a.i >= repeated, "
        "concat(a.m, array(struct(a.at + x.h as start, x.b as length))), a.m) as m), a -> a.m)").alias("loss"))


def _loose_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The windows of rows without a conversation id: one each, made where the row is."""
    t = _written(_said(rows.where(F.col(conv).isNull()), conv, turn, role, text), "conv_id")
    v = t.select("conv_id", F.lit(0).alias("window"), F.lit(0).alias("repeated"),
                 F.array(F.struct("f", "h", "b", "target")).alias("v"))
    return _joined(v, "conv_id", "window").select(*_ROW)


def _numbered_rows(rows: DataFrame, budget: int, history: int, **names: str) -> DataFrame:
    """The windows of conversations with an id."""
    t = turns(rows, **names)
    places = F.expr("concat(if(s > 0 and sys = 1, array(0), slice(array(0), 1, 0)), sequence(h, e - 1))")
    again = F.expr("s - h + if(s > 0, sys, 0)")
    members = spans(t, budget, history).select("conv_id", "window", again.alias("repeated"),
                                               F.posexplode_outer(places).alias("nth", "i"))
    held = members.join(t.select("conv_id", "i", "f", "h", "b", "target"), ["conv_id", "i"])
    v = held.groupBy("conv_id", "window").agg(
        F.max("repeated").alias("repeated"),
        F.array_sort(F.collect_list(F.struct("nth", "f", "h", "b", "target"))).alias("v"))
    return _joined(v, "conv_id", "window").select(*_ROW)


def window_rows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, **names: str) -> DataFrame:
    """One row a window: conv_id, window (from 0), text, repeated (how many turns at its start were seen
    before), loss (start and length of its targets, in characters)."""
    return _numbered_rows(rows, budget, history, **names).unionByName(_loose_rows(rows, **names))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, **names: str) -> DataFrame:
    """(conv_id, windows): per conversation its windows in order, each with ``text``, ``repeated`` and
    ``loss`` as in ``window_rows``."""
    held = F.array_sort(F.collect_list(F.struct("window", "text", "repeated", "loss")))
    whole = _numbered_rows(rows, budget, history, **names).groupBy("conv_id").agg(held.alias("w"))
    one = _loose_rows(rows, **names).select("conv_id", F.array(F.struct("window", "text", "repeated", "loss")).alias("w"))
    return whole.unionByName(one).select("conv_id", F.expr(
        "transform(w, x -> struct(x.text as text, x.repeated as repeated, x.loss as loss))").alias("windows"))


def exploded(formatted: DataFrame) -> DataFrame:
    """One row a window: conv_id, window (from 0), text, repeated, loss."""
    return formatted.select("conv_id", F.posexplode("windows").alias("window", "w")).select(
        "conv_id", "window", "w.text", "w.repeated", "w.loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, targets, formatted_chars) from the formatted windows alone.

    turns: struct(role, text) of each turn once, in order; targets: the unescaped texts under the loss masks."""
    # the parts between turn ends; what follows the last end is empty
    parts = formatted.select("conv_id", "windows", F.expr(
        "transform(windows, w -> struct(split(w.text, '</turn>\\n') as q, w.repeated as n))").alias("p"))
    pieces = parts.select("conv_id", "windows", F.expr(
        "flatten(transform(p, x -> slice(x.q, x.n + 1, size(x.q) - 1 - x.n)))").alias("p"))
    return pieces.select("conv_id", F.expr(
        "transform(p, x -> struct(" + _unescape("substring(x, 5, instr(x, '\\n') - 6)") + " as role, "
        + _unescape("substring(x, instr(x, '\\n') + 1)") + " as text))").alias("turns"), F.expr(
        "flatten(transform(windows, w -> transform(w.loss, m -> "
        + _unescape("substring(w.text, cast(m.start as int) + 1, cast(m.length as int))") + ")))").alias("targets"),
        F.expr("aggregate(windows, 0L, (a, w) -> a + char_length(w.text))").alias("formatted_chars"))


def digest(back: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``read_back``."""
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.expr(
        "sha2(array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), ''), 256)").alias("turns_sha256"),
        F.expr("cast(char_length(array_join(targets, '')) as bigint)").alias("loss_chars"),
        F.expr("sha2(array_join(targets, ''), 256)").alias("loss_sha256"), "formatted_chars")
