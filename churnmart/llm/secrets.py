"""Secret scan with a trigram index, in DataFrame functions only.

Each rule is a regular expression. From it a Boolean query over lower-case trigrams is
derived that every match must satisfy: clauses that all hold, each a choice of trigram sets.
Postings (trigram, text) of the trigrams that occur in some query are intersected per rule;
only the texts that remain are searched with the expression. A rule without mandatory
trigrams searches every text. Texts are known by their MD5, so copies have one posting.
"""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnmart.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``value`` is the group of which ``shortest`` characters are asked."""

    kind: str
    pattern: str
    value: int = 0
    shortest: int = 0
    any_case: bool = False

    @property
    def java(self):
        return ("(?i)" if self.any_case else "") + self.pattern


# The base kinds, in the order in which equal starts are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2, shortest=8, any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", shortest=16),
    # A run of 32 or more is the whole run: nothing shorter can stand before it.
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Added by this scanner.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[prs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{2,10}://[A-Za-z0-9._-]{1,64}:[^\s:@/]{4,128}@"),
)
RULES = BASE + ADDED

# Strings a run of characters may stand for before it is cut.
_MOST = 64


def trigram_query(pattern: str, any_case=False) -> list[list[frozenset]]:
    """Clauses; each is a list of trigram sets of which one must be wholly present."""
    clauses = []
    run = _walk(re._parser.parse(pattern, re.I if any_case else 0), {""}, clauses)
    _flush(run, clauses)
    return clauses


def _flush(run, clauses):
    """A finished run of characters as a clause; strings under three letters say nothing."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
    if all(sets):
        least = [a for a in sets if not any(b < a for b in sets)]
        clauses.append(sorted(least, key=sorted))
    return {""}


def _walk(items, run, clauses):
    """Extends the strings of ``run`` by ``items``; cuts it where characters are unknown."""
    for op, value in items:
        name = str(op)
        if name == "SUBPATTERN":
            run = _walk(value[3], run, clauses)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        else:
            strings = _strings(name, value)
            if strings and len(run) * len(strings) <= _MOST:
                run = {a + b for a in run for b in strings}
                if name == "MAX_REPEAT" and value[1] != value[0] and not (value[0] == 0 and value[1] == 1):
                    run = _flush(run, clauses)
            else:
                run = _flush(run, clauses)
                if name == "BRANCH":
                    parts = [_alternative(branch) for branch in value[1]]
                    if all(parts):
                        clauses.append([s for part in parts for s in part])
                elif name == "MAX_REPEAT" and value[0] >= 1:
                    run = _flush(_walk(value[2], run, clauses), clauses)
    return run


def _alternative(items):
    """One branch as trigram sets of which one must be present: those of its longest clause."""
    clauses = []
    _flush(_walk(items, {""}, clauses), clauses)
    return max(clauses, key=lambda c: min(map(len, c)), default=[])


def _strings(name, value):
    """All strings an item stands for, lower-case, if they are few; else an empty set."""
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN" and all(str(op) == "LITERAL" for op, _ in value):
        return {chr(v).lower() for _, v in value}
    if name == "IN" and all(str(op) in ("LITERAL", "RANGE") for op, _ in value):
        spans = [(v, v) if str(op) == "LITERAL" else v for op, v in value]
        few = {chr(c).lower() for a, b in spans for c in range(a, b + 1)} if sum(b - a + 1 for a, b in spans) <= 8 else set()
        return few
    if name in ("BRANCH", "SUBPATTERN"):
        found = [_sequence(part) for part in (value[1] if name == "BRANCH" else [value[3]])]
        return set().union(*found) if all(found) else set()
    if name == "MAX_REPEAT":
        least, most, items = value
        one = _sequence(items)
        if not one or least > 4:
            return set()
        if (least, most) == (0, 1):
            return one | {""}
        out = {""}
        for _ in range(least):
            out = {a + b for a in out for b in one}
            if len(out) > _MOST:
                return set()
        return out if least else set()
    return set()


def _sequence(items):
    out = {""}
    for op, value in items:
        strings = _strings(str(op), value)
        exact = str(op) != "MAX_REPEAT" or value[0] == value[1] or (value[0], value[1]) == (0, 1)
        if not strings or not exact or len(out) * len(strings) > _MOST:
            return set()
        out = {a + b for a in out for b in strings}
    return out


def postings(docs: DataFrame, rules=RULES, text_col="text") -> DataFrame:
    """(gram, text_id): which texts have which of the trigrams that the rules ask for."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern, r.any_case) for s in c for g in s})
    text = text_or_empty(text_col)
    asked = F.array(*[F.lit(g) for g in grams]) if grams else F.expr("cast(array() as array<string>)")
    # The outer array binds the lower-case text once for all trigrams.
    present = F.transform(F.array(F.lower(text)), lambda low: F.filter(asked, lambda g: F.contains(low, g)))[0]
    return docs.select(F.md5(text.cast("binary")).alias("text_id"), F.explode(present).alias("gram")).select("gram", "text_id")


def candidates(docs: DataFrame, rules=RULES, text_col="text") -> DataFrame:
    """(text_id, kinds): the rules whose Boolean query a text satisfies."""
    wanted = [
        (rule.kind, number, choice, gram, len(grams), len(query))
        for rule in rules
        for query in [trigram_query(rule.pattern, rule.any_case)]
        for number, clause in enumerate(query)
        for choice, grams in enumerate(clause)
        for gram in grams
    ]
    asked = docs.sparkSession.createDataFrame(
        wanted, "kind string, clause int, choice int, gram string, n_grams int, n_clauses int"
    )
    # As large as the rules, not as the data.
    met = postings(docs, rules, text_col).join(F.broadcast(asked), "gram")
    whole = (
        met.groupBy("text_id", "kind", "clause", "choice", "n_grams", "n_clauses")
        .agg(F.count_distinct("gram").alias("n"))
        .where("n = n_grams")
    )
    all_clauses = whole.groupBy("text_id", "kind", "n_clauses").agg(F.count_distinct("clause").alias("n")).where("n = n_clauses")
    return all_clauses.groupBy("text_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(text, rule: Rule, order: int):
    """Array of (start, order, end, kind) of the leftmost non-overlapping matches.

    What lies between matches and the matches themselves give all positions by their lengths.
    """
    pattern = F.lit(rule.java)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value))
    parts = F.arrays_zip(
        F.split(text, rule.java, -1).alias("gap"), matches.alias("found"), values.alias("value")
    )
    start = lambda acc, x: acc["at"] + F.length(x["gap"])
    span = lambda acc, x: F.struct(
        start(acc, x).cast("long").alias("start"), F.lit(order).alias("rank"),
        (start(acc, x) + F.length(x["found"])).cast("long").alias("end"), F.lit(rule.kind).alias("kind"),
    )
    # The last gap has no match after it.
    return F.aggregate(
        F.filter(parts, lambda x: x["found"].isNotNull()),
        F.struct(F.lit(0).alias("at"), _no_spans().alias("spans")),
        lambda acc, x: F.struct(
            (start(acc, x) + F.length(x["found"])).alias("at"),
            F.when(F.length(x["value"]) >= rule.shortest, F.concat(acc["spans"], F.array(span(acc, x))))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def _no_spans():
    return F.expr("cast(array() as array<struct<start: bigint, rank: int, end: bigint, kind: string>>)")


def find(docs: DataFrame, rules=RULES, text_col="text", column="spans") -> DataFrame:
    """``docs`` with an array of (start, rank, end, kind), by start and then rule order.

    Positions are code points, ends exclusive. NULL and empty texts have no spans. Rows are
    kept as they are, whatever their ids, repeats or further columns; ``column`` must be a
    new name. Texts of any length are searched whole. An empty table gives no rows.
    """
    text = text_or_empty(text_col)
    found = candidates(docs, rules, text_col).select(
        F.col("text_id").alias(f"{column} of text"), F.col("kinds").alias(f"{column} kinds")
    )
    rows = docs.join(found, F.md5(text.cast("binary")) == found[f"{column} of text"], "left")
    arrays = []
    for order, rule in enumerate(rules):
        scan_all = not trigram_query(rule.pattern, rule.any_case)
        here = F.rlike(text, F.lit(rule.java)) if scan_all else F.array_contains(f"`{column} kinds`", rule.kind)
        arrays.append(F.when(here, _spans(text, rule, order)).otherwise(_no_spans()))
    return rows.withColumn(column, F.array_sort(F.concat(*arrays))).drop(f"{column} of text", f"{column} kinds")


def listed(spans):
    """Column expression: kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scan(docs: DataFrame, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """Spans of every whole text, counted by base kind, listed and digested; see ``find``."""
    rows = find(docs.select(id_col, text_col), rules, text_col, "spans")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [_count("spans", rule.kind).alias(f"n_{rule.kind}") for rule in BASE]
    return rows.select(
        id_col, *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, text_col="text", rules=RULES, mask="[secret]", column="spans") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by ``mask``; touching spans share one.

    NULL texts stay NULL; texts without spans stay as they are.
    """
    rows = find(docs, rules, text_col, column)
    text = F.col(f"`{text_col}`")
    cut = F.aggregate(
        F.col(column),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] > acc["at"]) | ((s["start"] == acc["at"]) & (F.size(acc["out"]) == 0)),
                F.concat(acc["out"], F.array(text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mask))),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr((acc["at"] + 1).cast("int"), F.length(text))),
    )
    return rows.withColumn(text_col, F.when(F.size(column) > 0, cut).otherwise(text)).drop(column)
