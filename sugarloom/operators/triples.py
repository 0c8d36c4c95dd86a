"""Triples and patterns over them, as DataFrames.

triples are rows (s, p, o, o_kind, o_type): o_kind is uri, bnode or literal. Names are prefixed, as in
onto:mass; a prefix map turns them into addresses where they are written.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.operators.staging import new_path

TRIPLE = "array<struct<s:string,p:string,o:string,o_kind:string,o_type:string>>"


def uri(s: Column, p: str, o: Column | str) -> Column:
    return _one(s, p, F.lit(o) if isinstance(o, str) else o, "uri", F.lit(None).cast("string"))


def linked(s: Column, p: str, node: Column) -> Column:
    """A triple to a blank node."""
    return _one(s, p, node, "bnode", F.lit(None).cast("string"))


def literal(s: Column, p: str, value: Column, kind: str | None = None) -> Column:
    """A literal of the declared kind (string, integer, double, boolean), as string where it can't be cast; without a
    declared kind the narrowest that fits. Null and empty values give no triple."""
    text = value.cast("string")
    as_int, as_double = text.try_cast("double").try_cast("long"), text.try_cast("double")
    if kind == "integer":
        o, t = F.coalesce(as_int.cast("string"), text), F.when(as_int.isNotNull(), "integer").otherwise("string")
    elif kind == "double":
        o, t = F.coalesce(as_double.cast("string"), text), F.when(as_double.isNotNull(), "double").otherwise("string")
    elif kind:
        o, t = text, F.lit(kind)
    else:
        whole = text.try_cast("long").isNotNull() & text.rlike("^-?[0-9]+$")
        t = F.when(text.isin("true", "false"), "boolean").when(whole, "integer").when(as_double.isNotNull(), "double").otherwise("string")
        o = text
    return _where(text.isNotNull() & (text != ""), _one(s, p, o, "literal", t))


def _one(s: Column, p: str, o: Column, kind: str, o_type: Column) -> Column:
    out = F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), o_type.alias("o_type"))
    out.predicate = p
    return out


def _where(condition: Column, triple: Column) -> Column:
    """The triple where the condition holds; which predicate it has stays known."""
    out = F.when(condition, triple)
    out.predicate = vars(triple).get("predicate")
    return out


def blank(*parts: Column) -> Column:
    """The same id for the same parts on every run."""
    return F.concat(F.lit("_:"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24))


def quantity(s: Column, p: str, value: Column, unit: str, kind: str) -> list[Column]:
    """A value with its unit behind a blank node; none for a null value."""
    node = blank(s, F.lit(p))
    there = value.isNotNull() & (value.cast("string") != "")
    rows = [_one(s, p, node, "bnode", F.lit(None).cast("string")), uri(node, "rdf:type", "qudt:Quantity"), uri(node, "rdf:type", kind), literal(node, "qudt:numericValue", value, "double"), uri(node, "qudt:hasUnit", unit)]
    return [_where(there, x) for x in rows]


def counted(s: Column, p: str, name: Column, n: Column, part: str) -> list[Column]:
    """A part and how often it occurs, behind a blank node."""
    node, thing = blank(s, F.lit(p), name), F.concat(F.lit(part + "/"), name)
    return [_one(s, p, node, "bnode", F.lit(None).cast("string")), uri(node, "onto:part", thing), uri(thing, "rdf:type", "skos:Concept"), literal(thing, "rdfs:label", name, "string"), literal(node, "onto:count", n, "integer")]


def sequence(s: Column, value: Column, label: str, form: str) -> list[Column]:
    node = F.concat(s, F.lit("/sequence/" + label))
    there = value.isNotNull() & (value != "")
    return [_where(there, x) for x in (uri(s, "onto:sequence", node), uri(node, "rdf:type", "onto:Sequence"), literal(node, "onto:text", value, "string"), uri(node, "onto:form", form))]


def emit(rows: DataFrame, triples: Sequence[Column], repeats: bool = False, only: Collection[str] | None = None) -> DataFrame:
    """All triples of all rows; repeats collapse, unless what follows takes care of them. only: no triples of predicates
    that are not among these are made."""
    if only is not None:
        triples = [x for x in triples if vars(x).get("predicate") is None or x.predicate in only]
        if not triples:
            return rows.sparkSession.createDataFrame([], TRIPLE[len("array<struct<") : -2].replace(":", " "))
    out = rows.select(F.explode(F.filter(F.array(*triples), lambda x: x.isNotNull())).alias("t")).select("t.*")
    if only is not None:
        out = out.where(F.col("p").isin(*only))
    return out if repeats else out.distinct()


def lines(triples: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """One line of N-Triples a row."""
    def full(x: Column) -> Column:
        out = F.concat(F.lit("<"), x, F.lit(">"))
        for p, base in prefixes.items():
            out = F.when(x.startswith(p + ":"), F.concat(F.lit("<" + base), F.substring(x, F.lit(len(p) + 2), F.length(x)), F.lit(">"))).otherwise(out)
        return F.when(x.startswith("_:"), x).otherwise(out)

    escaped = F.replace(F.replace(F.replace(F.col("o"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    typed = F.when(F.col("o_type").isNotNull(), F.concat(F.lit("^^<http://www.w3.org/2001/XMLSchema#"), F.col("o_type"), F.lit(">"))).otherwise("")
    o = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), escaped, F.lit('"'), typed)).otherwise(full(F.col("o")))
    return triples.select(F.concat_ws(" ", full(F.col("s")), full(F.col("p")), o, F.lit(".")).alias("value"))


class Store:
    """Triples written once: a folder for each predicate, within it the subjects dealt over as many sorted buckets as there
    are shuffle partitions. A pattern reads its predicate only, patterns about one subject are joined without a shuffle,
    and what the predicates hold, a row each, tells which pattern to begin with."""

    def __init__(self, triples: DataFrame):
        spark = triples.sparkSession
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = new_path(spark, "triples")
        self.name = path.rsplit("/", 1)[1].replace("-", "_")
        # equal triples have one subject, so they collapse where the buckets are dealt
        dealt = triples.repartition(tasks, "s").distinct()
        dealt.write.partitionBy("p").bucketBy(tasks, "s").sortBy("s").option("path", path).saveAsTable(self.name)
        self.triples = spark.table(self.name)
        about = self.triples.groupBy("p").agg(F.count("*").alias("n"), F.approx_count_distinct("s").alias("subjects"), F.approx_count_distinct("o").alias("objects"))
        self.about = {r["p"]: (r["n"], r["subjects"], r["objects"]) for r in about.collect()}

    def rows(self, pattern: tuple[str, str, str]) -> float:
        """About how many triples meet a pattern by itself."""
        s, p, o = pattern
        n, subjects, objects = self.about.get(p, (0, 1, 1)) if not p.startswith("?") else tuple(map(sum, zip(*self.about.values(), strict=True))) or (0, 1, 1)
        return n / (1 if s.startswith("?") else max(1, subjects)) / (1 if o.startswith("?") else max(1, objects))

    def ordered(self, patterns: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
        """The patterns from the one with the fewest triples on, each next one sharing a variable with those before
        where there is such a one, one about a subject already named first."""
        left, out, known = list(patterns), [], set()
        while left:
            best = min(left, key=lambda x: (bool(known) and not known & _variables(x), bool(known) and x[0] not in known, self.rows(x), left.index(x)))
            left.remove(best)
            out.append(best)
            known |= _variables(best)
        return out


def _variables(pattern: tuple[str, str, str]) -> set[str]:
    return {x for x in pattern if x.startswith("?")}


def predicates(*patterns: tuple[str, str, str]) -> set[str] | None:
    """The predicates that patterns ask for; None: any."""
    named = {p for _, p, _ in patterns}
    return None if any(p.startswith("?") for p in named) else named


def match(triples: DataFrame | Store, patterns: Sequence[tuple[str, str, str]], optional: Sequence[tuple[str, str, str]] = (), filters: Sequence[Column] = ()) -> DataFrame:
    """One column a variable (?name) for every way to meet all patterns and filters (conditions on variables); optional
    patterns may stay null.

    Each pattern is a filtered projection of the triples, joined on the variables it shares: in a store's order, of other
    triples in the given one. No pattern gives no column.
    """
    out = None
    if isinstance(triples, Store):
        patterns, triples = triples.ordered(patterns), triples.triples
    for i, pattern in enumerate([*patterns, *optional]):
        one = triples
        for col, term in zip("spo", pattern, strict=True):
            if not term.startswith("?"):
                one = one.where(F.col(col) == term)
        names = {}
        for col, term in zip("spo", pattern, strict=True):
            if term.startswith("?"):
                if term in names:
                    one = one.where(F.col(names[term]) == F.col(col))
                names.setdefault(term, col)
        one = one.select(*(F.col(c).alias(v[1:]) for v, c in names.items()))
        if out is None:
            out = one
        else:
            shared = [v[1:] for v in names if v[1:] in out.columns]
            out = out.join(one, shared, "left" if i >= len(patterns) else "inner")
    for condition in filters:
        out = out.where(condition)
    return out
