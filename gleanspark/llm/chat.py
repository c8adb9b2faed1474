"""Chat formatting from a declarative template (operator 1), in DataFrame functions alone.

A template names the marks around a turn, the roles' labels, which roles bear
loss, and a finite-state machine over roles. Texts are escaped so that no mark
can occur in them: the output can be cut at its marks and gives every text back.

A conversation is worked on in blocks of turns, so that a very long one is
spread over tasks. For each block the machine is run from every state; the
blocks' results are composed in order, and only segments and states meet.

Turns stand in order of (turn, role, text), null turns first; repeated rows are
turns of their own. Null roles and texts count as empty. A role that the template
doesn't know is written by name and makes the conversation invalid; invalid
conversations are formatted like others.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm.common import table

#: Turns of a conversation that one group holds.
BLOCK_TURNS = 256


@dataclass(frozen=True)
class Template:
    start: str = "### "
    between: str = ": "
    end: str = "</turn>"
    after: str = "\n"
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple[str, ...] = ("assistant",)
    first: str = "start"
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})
    accepts: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        for mark in (self.start, self.between, self.end):
            if not mark or "\\" in mark:
                raise ValueError("marks are not empty and hold no backslash")
        if any(self.between in x or x.startswith("role=") or "\\" in x or self.end in x for x in self.labels.values()):
            raise ValueError("labels hold no mark and don't start with role=")

    @property
    def signs(self) -> list[tuple[str, str]]:
        """What stands for a backslash, then for each mark: letters that no mark holds, so that no new mark can come up."""
        free = [c for c in "bcdefghijklmnopqrstuvwxyz" if c not in self.start + self.between + self.end]
        return list(zip(["\\", self.start, self.end, self.between], free, strict=False))

    def escape(self, text: Column, in_role: bool = False) -> Column:
        signs = self.signs if in_role else self.signs[:3]
        return reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit("\\" + s[1])), signs, text)

    def unescape(self, text: Column) -> Column:
        return reduce(lambda c, s: F.replace(c, F.lit("\\" + s[1]), F.lit(s[0])), [*self.signs[1:], self.signs[0]], text)

    def header(self, role: Column) -> Column:
        known = reduce(lambda c, kv: c.when(role == kv[0], F.lit(kv[1])), list(self.labels.items())[1:], F.when(role == next(iter(self.labels)), F.lit(next(iter(self.labels.values())))))
        return F.concat(F.lit(self.start), known.otherwise(F.concat(F.lit("role="), self.escape(role, True))), F.lit(self.between))

    @property
    def states(self) -> list[str]:
        return list(dict.fromkeys([self.first, *self.moves, *(s for m in self.moves.values() for s in m.values())]))


def _run(template: Template, turns: Column, state: str) -> Column:
    """struct<state, bad>: where the machine ends from `state`, and the first turn it has no move for (the state is empty from there)."""
    moves = F.create_map(*[F.lit(x) for s, m in template.moves.items() for r, to in m.items() for x in (f"{s}\n{r}", to)])

    def step(at: Column, t: Column) -> Column:
        to = F.coalesce(moves[F.concat(at["state"], F.lit("\n"), t["role"])], F.lit(""))
        return F.when(at["state"] == "", at).otherwise(F.struct(to.alias("state"), F.when(to == "", F.coalesce(t["turn"], F.lit(-1))).alias("bad")))

    return F.aggregate(turns, F.struct(F.lit(state).alias("state"), F.lit(None).cast("long").alias("bad")), step)


def format_chats(turns: DataFrame, template: Template | None = None, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """From (conv_id, turn, role, text): conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>.

    The segments' texts put together are the formatted conversation; loss marks
    just the texts of loss roles. bad_turn is the first turn the machine has no
    move for (-1 for a null turn); it is null too if turns merely stop too early,
    and valid is then false.
    """
    template = template or Template()
    role = F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "block", F.floor(F.col("turn") / block_turns))
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(template.header(t["role"]), F.lit(False)),
        segment(template.escape(t["text"]), t["role"].isin(*template.loss_roles)),
        segment(F.lit(template.end + template.after), F.lit(False)))))
    states = template.states
    blocks = blocks.select(
        "conv_id", "block", F.size("turns").cast("long").alias("n"), segments.alias("segments"),
        F.create_map(*[x for s in states for x in (F.lit(s), _run(template, F.col("turns"), s))]).alias("ends"))
    whole = blocks.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("block", "segments", "ends")),
                                          lambda a, b: F.when(a["block"].isNull(), -1).when(b["block"].isNull(), 1).otherwise((a["block"] - b["block"]).cast("int"))).alias("blocks"))
    end = F.aggregate(
        "blocks", F.struct(F.lit(template.first).alias("state"), F.lit(None).cast("long").alias("bad")),
        lambda at, b: F.when(at["state"] == "", at).otherwise(F.struct(
            F.coalesce(b["ends"][at["state"]]["state"], F.lit("")).alias("state"), b["ends"][at["state"]]["bad"].alias("bad"))))
    return whole.withColumn("end", end).select(
        "conv_id", "n_turns", F.col("end.state").isin(*template.accepts).alias("valid"), F.col("end.bad").alias("bad_turn"),
        F.flatten(F.transform("blocks", lambda b: b["segments"])).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(text: Column, template: Template | None = None) -> Column:
    """array<struct<role, text>> from a formatted conversation."""
    template = template or Template()
    cut = F.split(text, "\\Q" + template.end + template.after + "\\E", -1)
    names = {v: k for k, v in template.labels.items()}

    def turn(t: Column) -> Column:
        body = F.substring(t, len(template.start) + 1, 1 << 30)
        label = F.substring_index(body, template.between, 1)
        known = reduce(lambda c, kv: c.when(label == kv[0], F.lit(kv[1])), list(names.items())[1:], F.when(label == next(iter(names)), F.lit(next(iter(names.values())))))
        role = known.otherwise(template.unescape(F.substring(label, len("role=") + 1, 1 << 30)))
        return F.struct(role.alias("role"), template.unescape(F.substr(body, F.length(label) + len(template.between) + 1)).alias("text"))

    return F.transform(F.slice(cut, 1, F.greatest(F.size(cut) - 1, F.lit(0))), turn)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = Template()
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_chats(turns, template).withColumn("formatted", formatted(F.col("segments")))
    out = out.withColumn("turns", read_back(F.col("formatted"), template)).withColumn(
        "loss", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"])), ""))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "bad_turn")


# the same in SQL; invalid conversations by comparing each role with the one before it
OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, lag(role, 1, '') OVER w AS was, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS of,
    replace(replace(replace(text, '\', '\b'), '### ', '\c'), '</turn>', '\d') AS escaped
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), b AS (
  SELECT *, NOT ((place = 1 AND role IN ('system', 'user')) OR (place = 2 AND was = 'system' AND role = 'user')
    OR (was = 'user' AND role = 'assistant') OR (was = 'assistant' AND role = 'user')) AS bad FROM o
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE 'role=' || role END
    || ': ' || escaped || '</turn>' || chr(10)))::BIGINT AS formatted_chars,
  NOT bool_or(bad) AND max(role) FILTER (place = of) = 'assistant' AS valid,
  coalesce(min(turn) FILTER (bad), NULL) AS bad_turn
FROM b GROUP BY conv_id
"""
