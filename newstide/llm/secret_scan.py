"""Secret scan by a trigram inverted index, in DataFrame operations only.

Every rule is a regular expression. From its parsed form follows a Boolean query over trigrams that any text with a match
must satisfy: a conjunction of clauses, each a choice of trigram sets. The index holds, for the trigrams that the rules
ask for, the texts that contain them; postings are intersected per trigram set, sets are united per clause, clauses are
intersected per rule. Only the candidates so found are run through the rule's expression. Rules without a mandatory
trigram are run over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import free_name
from newstide.session import stage


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` code points for a match to count; a match that fails still uses up its text."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


#: The base rules. A run of hex digits counts from 24 on; asking for 24 in the pattern finds the same runs.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)
#: Further kinds of keys with a fixed public form.
EXTRA = (
    Rule("private_key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)

#: Strings kept for a run of literals before it is turned into a clause.
MAX_STRINGS = 64

Clause = tuple[frozenset[str], ...]


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses of trigram sets, in lower case: a match needs, for every clause, all trigrams of one of its sets."""
    import re._constants as K
    import re._parser as parser

    clauses: list[Clause] = []

    def strings(items) -> set[str] | None:
        """All texts that the items match, if they are few; else None."""
        found = {""}
        for op, arg in items:
            own = one(op, arg)
            if own is None or len(found) * len(own) > MAX_STRINGS:
                return None
            found = {a + b for a, b in product(found, own)}
        return found

    def one(op, arg) -> set[str] | None:
        if op is K.LITERAL:
            return {chr(arg).lower()}
        if op is K.IN and all(o is K.LITERAL for o, _ in arg):
            return {chr(a).lower() for _, a in arg}
        if op is K.SUBPATTERN:
            return strings(arg[3])
        if op is K.BRANCH:
            parts = [strings(b) for b in arg[1]]
            return None if None in parts or sum(map(len, parts)) > MAX_STRINGS else set().union(*parts)
        if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1:
            inner = strings(arg[2])
            return None if inner is None else inner | {""}
        if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] == arg[1] <= 3:
            return strings(list(arg[2]) * arg[0])
        return None

    def close(found: set[str]) -> None:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in found}
        if frozenset() not in sets:
            clauses.append(tuple(sorted(sets, key=sorted)))

    def walk(items) -> None:
        run = {""}
        for op, arg in items:
            own = one(op, arg)
            if own is not None and len(run) * len(own) <= MAX_STRINGS:
                run = {a + b for a, b in product(run, own)}
                continue
            close(run)
            run = {""}
            if own is not None:
                run = own
            elif op is K.SUBPATTERN:
                walk(arg[3])
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
                walk(arg[2])
        close(run)

    walk(parser.parse(pattern))
    return clauses


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of the rule's matches, in code points, leftmost and not overlapping.

    Matches and the texts between them come from the same expression, so lengths add up to positions. Positions are
    summed in blocks of 256 matches, which keeps texts with very many matches cheap.
    """
    pattern = F.lit(rule.java)
    size = 256
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.java, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("len"),
        F.transform(kept, F.length).alias("kept"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,kept:int>>")

    def add(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        span = F.struct(start.alias("start"), (start + s["len"]).alias("end"), s["kept"].alias("kept"))
        return F.struct((start + s["len"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def block_of(steps: Column, b: Column) -> Column:
        return F.aggregate(F.slice(steps, b * size + 1, F.lit(size)), F.struct(F.lit(0).alias("at"), empty.alias("out")), add)

    def shifted(acc: Column, b: Column) -> Column:
        moved = F.transform(b["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["kept"].alias("kept")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def positions(steps: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / size).cast("int")), lambda b: block_of(steps, b))
        return F.flatten(F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,kept:int>>>").alias("out")), shifted)["out"])

    # A one-element array binds the lengths to a name, so that they are computed once.
    spans = F.transform(
        F.filter(F.transform(F.array(F.filter(lengths, lambda s: s["len"].isNotNull())), positions)[0], lambda s: s["kept"] >= rule.least),
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")),
    )
    return F.when(text.rlike(rule.java), spans)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, text_key): for each trigram asked for, the keys of the distinct texts that contain it in any case."""
    low = docs.select(F.xxhash64("text").alias("text_key"), F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(g)) for g in grams]))
    return low.select("text_key", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: dict[str, list[Clause]]) -> DataFrame:
    """(text_key, kinds): the rules whose trigram query a text satisfies."""
    asked = [(kind, c, s, gram, len(grams)) for kind, clauses in rules.items() for c, sets in enumerate(clauses) for s, grams in enumerate(sets) for gram in sorted(grams)]
    spark = docs.sparkSession
    # As large as the rules, not the data.
    wanted = spark.createDataFrame(asked, "kind string, clause int, choice int, gram string, of int")
    sizes = spark.createDataFrame([(kind, len(clauses)) for kind, clauses in rules.items()], "kind string, clauses int")
    index = stage(postings(docs, sorted({a[3] for a in asked})).distinct(), "postings")
    met = (
        index.join(F.broadcast(wanted), "gram")
        .groupBy("text_key", "kind", "clause", "choice").agg(F.count("*").alias("n"), F.first("of").alias("of"))
        .where("n = of")
        .groupBy("text_key", "kind").agg(F.countDistinct("clause").alias("met"))
        .join(F.broadcast(sizes), "kind")
        .where("met = clauses")
    )
    return met.groupBy("text_key").agg(F.collect_set("kind").alias("kinds"))  # at most one entry per rule


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA, out: str = "secrets") -> DataFrame:
    """All columns of ``docs`` and ``out``, an array of (start, order, end, kind) sorted by start and rule order.

    A null text has no secrets and stays null; a column named ``out`` in the input is replaced. Rows are neither lost nor
    merged: equal texts share their postings only. An empty table gives an empty result.
    """
    docs = docs.drop(out)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: clauses for kind, clauses in queries.items() if clauses}
    key, kinds = free_name(docs, "text_key"), free_name(docs, "kinds")
    rows = docs.withColumn(key, F.xxhash64("text"))
    if indexed:
        # Staged, so that the planner sees its size, and can split hot texts of the other side.
        found = stage(candidates(docs.select("text"), indexed).select(F.col("text_key").alias(key), F.col("kinds").alias(kinds)), "candidates")
        rows = rows.join(found.hint("shuffle_hash"), key, "left")
    else:
        rows = rows.withColumn(kinds, F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    parts = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, order)
        if rule.kind in indexed:
            spans = F.when(F.array_contains(kinds, rule.kind), spans)
        parts.append(F.coalesce(spans, none))
    return rows.withColumn(out, F.array_sort(F.concat(*parts))).select(*docs.columns, out)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(docs: DataFrame, mask: str = "[SECRET]", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``, overlapping ones by one mask; other texts stay as they are."""
    secrets = free_name(docs, "secrets")
    text, spans = F.col("text"), F.col(secrets)

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    rows = find_secrets(docs, rules, secrets)
    return rows.withColumn("text", F.when(F.size(spans) > 0, done).otherwise(text)).select(*docs.columns)
