"""Secret scan through a trigram inverted index.

Each rule's regular expression is turned into a Boolean trigram query: a text that matches must hold all
trigrams of at least one alternative. The index has a posting (document, trigram) for every trigram that
some query asks for; a query is answered by intersecting postings per document, and the documents it leaves
are verified with the expression itself. A rule without mandatory trigrams is verified on every document.
The index folds case, so a query may let through too much but never too little.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

#: An alternative set larger than this is not multiplied out; the query then asks for less.
MOST_ALTERNATIVES = 64
#: Trigrams per bit mask.
MASK_BITS = 62


@dataclass(frozen=True)
class Rule:
    """``pattern`` must not match the empty text. Matches whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are matched whole, so asking for 32 at once finds the same spans as dropping shorter runs.
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES

Query = frozenset  # alternatives, each a frozenset of trigrams that must all be there
ANYTHING: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_ALTERNATIVES:
        return a if b == ANYTHING or len(a) <= len(b) else b
    return frozenset(x | y for x in a for y in b)


def _of_texts(texts: set[str]) -> Query:
    found = frozenset(frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts)
    return ANYTHING if frozenset() in found else found


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """The only texts a sequence can match, if few, and what any match must hold beside them."""
    texts, need, whole = {""}, ANYTHING, True
    for code, value in nodes:
        exact, inner = None, ANYTHING
        if code is op.LITERAL:
            exact = {chr(value).lower()}
        elif code is op.IN and all(c is op.LITERAL for c, _ in value) and len(value) <= 8:
            exact = {chr(v).lower() for _, v in value}
        elif code is op.SUBPATTERN:
            exact, inner = _walk(value[3])
        elif code is op.BRANCH:
            parts = [_walk(branch) for branch in value[1]]
            if all(t is not None for t, _ in parts):
                exact = set().union(*[t for t, _ in parts])
            else:
                inner = frozenset().union(*[q if t is None else _both(q, _of_texts(t)) for t, q in parts])
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, body = value
            once, within = _walk(body)
            if once is not None and within == ANYTHING and high == 1:
                exact = once | ({""} if low == 0 else set())
            elif low > 0:
                inner = within if once is None else _both(within, _of_texts(once))
        if exact is not None and len(exact) * len(texts) <= MOST_ALTERNATIVES:
            texts = {a + b for a in texts for b in exact}
            need = _both(need, inner)
            continue
        if exact is not None:
            inner = _both(inner, _of_texts(exact))
        need, texts, whole = _both(_both(need, _of_texts(texts)), inner), {""}, False
    if not whole:
        need = _both(need, _of_texts(texts))
    return (texts if whole else None), need


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams, or ``ANYTHING`` where nothing is mandatory."""
    texts, need = _walk(parser.parse(pattern))
    need = need if texts is None else _both(need, _of_texts(texts))
    return frozenset(a for a in need if not any(b < a for b in need))  # a weaker alternative covers a stronger one


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, trigram number) for each of ``trigrams`` that a text holds in either case."""
    low = F.lower(docs[text_col])
    found = F.array(*[F.when(F.contains(low, F.lit(t)), i) for i, t in enumerate(trigrams)])
    return docs.select(docs[id_col].alias("id"), F.explode(F.array_compact(found)).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one flag per indexed rule) of the documents that satisfy some rule's trigram query."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {kind: q for kind, q in queries.items() if q != ANYTHING}
    trigrams = sorted(set().union(*[t for q in queries.values() for t in q]))
    place = {t: divmod(i, MASK_BITS) for i, t in enumerate(trigrams)}
    words = range(len(trigrams) // MASK_BITS + 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % MASK_BITS).cast("int"))
    held = postings(docs, trigrams, id_col, text_col).groupBy("id").agg(
        *[F.bit_or(F.when(F.floor(F.col("trigram") / MASK_BITS) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words])

    def holds(alternative: frozenset) -> Column:
        masks = [sum(1 << place[t][1] for t in alternative if place[t][0] == w) for w in words]
        return reduce(Column.__and__, [F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in zip(words, masks) if m])

    flags = {kind: reduce(Column.__or__, [holds(a) for a in q]) for kind, q in queries.items()}
    return held.select("id", *[f.alias(f"may_{kind}") for kind, f in flags.items()]).filter(
        reduce(Column.__or__, [F.col(f"may_{kind}") for kind in flags]))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Structs (start, kind number, end) of a rule's matches in order, in code points."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), hits.alias("hit"), tested.alias("tested"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(seen: Column, part: Column) -> Column:
        start = seen["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        here = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        good = part["hit"].isNotNull() & (F.length(part["tested"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(seen["found"], here)).otherwise(seen["found"]).alias("found"))

    first = F.struct(F.lit(0).alias("at"), none.alias("found"))
    found = F.aggregate(parts, first, add, lambda seen: seen["found"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(none)


def as_text(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, by start and then kind as listed, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and per rule ``spans_<kind>``, an array of (start, kind number, end).

    A null text counts as empty and has no spans. Rows with one id keep their own spans. A row with a null id
    is verified by all rules. Other columns of ``docs`` are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    indexed = [r for r in rules if trigram_query(r.pattern) != ANYTHING]
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    if indexed:
        rows = rows.join(candidates(docs, rules, id_col, text_col), "id", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    columns = []
    for number, rule in enumerate(rules):
        found = spans(text, rule, number)
        if rule in indexed:
            found = F.when(F.col(f"may_{rule.kind}") | F.col("id").isNull(), found).otherwise(none)
        columns.append(found.alias(f"spans_{rule.kind}"))
    return rows.select(F.col("id").alias(id_col), *columns)
