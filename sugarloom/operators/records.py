"""Records: lookups with fallback, upserts, patches, manifests, coverage, run states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.functions.columns import clean_null, normal_list


def with_fallback(rows: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame]], columns: Sequence[str]) -> DataFrame:
    """rows with `columns` of the first source that has the key, and `origin`, that source's name (null: none).

    Of a key's rows in one source the least by its columns counts, whole, so that reruns agree; sources are
    looked up in turn, and a source that lacks a value lets the next one give it.
    """
    out, marks = rows, []
    for i, (name, table) in enumerate(sources):
        least = table.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row"))
        once = least.select(key, *(F.col(f"_row.{c}").alias(f"_{i}_{c}") for c in columns), F.lit(name).alias(f"_{i}"))
        out = out.join(once, key, "left")
        marks.append(F.col(f"_{i}"))
    picked = [F.coalesce(*(F.col(f"_{i}_{c}") for i in range(len(sources)))).alias(c) for c in columns]
    return out.select(*rows.columns, *picked, F.coalesce(*marks).alias("origin"))


def upsert(old: DataFrame, new: DataFrame, key: str, action: str = "action") -> DataFrame:
    """old overridden by new where new has a value, rows of new that old lacks added; rows of new without the key are
    left out. action: kept, updated or created."""
    columns = [c for c in old.columns if c != key]
    n = new.where(F.col(key).isNotNull()).select(key, *(F.col(c).alias("_" + c) for c in columns), F.lit(True).alias("_new"))
    both = old.withColumn("_old", F.lit(True)).join(n, key, "full")
    said = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "created").otherwise("updated")
    return both.select(key, *(F.coalesce("_" + c, c).alias(c) for c in columns), said.alias(action))


def upsert_entries(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], lists: Sequence[str], text: str = "search_text") -> DataFrame:
    """upsert() of entries: list columns of new come as normal lists, rows whose key is blank are left out, and the search
    text is built anew from the merged row wherever new has a row; the others keep theirs."""
    keyed = new.where(clean_null(F.col(key).cast("string")).isNotNull())
    normal = keyed.withColumns({c: normal_list(F.col(c)) for c in lists if c in new.columns})
    for c in old.columns:
        if c not in normal.columns:
            normal = normal.withColumn(c, F.lit(None).cast(old.schema[c].dataType))
    merged = upsert(old, normal, key)
    built = search_text([F.col(c).cast("string") for c in fields], [F.col(c) for c in lists])
    return merged.withColumn(text, F.when(F.col("action") == "kept", F.col(text)).otherwise(built))


def patch(records: DataFrame, changes: DataFrame, id_key: str, name_key: str, columns: Sequence[str]) -> DataFrame:
    """records with columns of changes found by id, else by name; no match changes nothing. Of a key's changes the least
    row by those columns counts, whole."""
    least = lambda k: changes.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(F.struct(*columns)).alias("_row"))
    by = lambda k, tag: least(k).select(k, *(F.col(f"_row.{c}").alias(f"{tag}{c}") for c in columns))
    both = records.join(by(id_key, "_i_"), id_key, "left").join(by(name_key, "_n_"), name_key, "left")
    return both.select(*(F.coalesce(f"_i_{c}", f"_n_{c}", c).alias(c) if c in columns else F.col(c) for c in records.columns))


def insert_absent(old: DataFrame, new: DataFrame, key: str, needed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(old with the rows of new that it lacks, counts by outcome): rows without a needed value are skipped; of the rows of
    new with one key the least complete one is created, the others count as present."""
    has = [clean_null(F.col(c)).isNotNull() for c in needed]
    complete = has[0]
    for h in has[1:]:
        complete = complete & h
    marked = new.join(old.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    turn = F.row_number().over(W.partitionBy(key, complete).orderBy(*(c for c in old.columns if c != key)))
    marked = marked.withColumn("_turn", turn).withColumn("outcome", F.when(~complete, "incomplete").when(F.col("_there") | (F.col("_turn") > 1), "present").otherwise("created"))
    added = marked.where("outcome = 'created'").select(*old.columns)
    return old.unionByName(added), marked.groupBy("outcome").agg(F.count("*").alias("n"))


def copy_plan(source: DataFrame, target: DataFrame, key: str = "path", everything: bool = False) -> DataFrame:
    """What is to be copied: keys that the target lacks, or all."""
    return source if everything else source.join(target.select(key), key, "left_anti")


def completeness(record: dict[str, Column], null_words: Sequence[str] = ()) -> Column:
    """True with a name, an id and an accession or a sequence; words like null and TODO are no values."""
    has = {k: clean_null(v, null_words).isNotNull() for k, v in record.items()}
    return has["name"] & has["id"] & (has["accession"] | has["sequence"])


def gate(rows: DataFrame, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, the others with the first check they fail as `reason`)."""
    reason = F.lit(None).cast("string")
    for name, good in reversed(checks):
        reason = F.when(~F.coalesce(good, F.lit(False)), name).otherwise(reason)
    marked = rows.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def name_match(name: Column, wanted: Column, exact: bool) -> Column:
    return name == wanted if exact else F.lower(name).contains(F.lower(wanted))


def resolve(variants: DataFrame, registry: DataFrame, key: str = "sequence", found: str = "accession") -> DataFrame:
    """variants with missing accessions looked up by sequence, and `outcome`: given, resolved, still_missing or unasked
    (without a sequence). One row of the registry a sequence counts."""
    known = registry.groupBy(key).agg(F.min(found).alias("_found"))
    own = clean_null(F.col(found))
    out = variants.join(known, key, "left")
    outcome = F.when(own.isNotNull(), "given").when(clean_null(F.col(key)).isNull(), "unasked").when(F.col("_found").isNotNull(), "resolved").otherwise("still_missing")
    return out.select(*(c for c in variants.columns if c != found), F.coalesce(own, F.when(clean_null(F.col(key)).isNotNull(), F.col("_found"))).alias(found), outcome.alias("outcome"))


def first_writer(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """The row of the earliest source that has the key, the least one by its columns if there are several."""
    out = None
    columns = sorted(c for c in sources[0].columns if c != key)
    for i, s in enumerate(sources):
        s = s.withColumn("_turn", F.lit(i))
        out = s if out is None else out.unionByName(s)
    return out.withColumn("_at", F.row_number().over(W.partitionBy(key).orderBy("_turn", *columns))).where("_at = 1").drop("_at", "_turn")


def set_report(required: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, status): present, missing or extra, of each required or actual row."""
    r, a = required.select(*keys).distinct().withColumn("_r", F.lit(True)), actual.select(*keys).distinct().withColumn("_a", F.lit(True))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_r").isNull(), "extra").otherwise("present")
    return r.join(a, list(keys), "full").select(*keys, status.alias("status"))


def coverage_tree(report: DataFrame, entry: str, path: str) -> DataFrame:
    """(entry, node, status): each path and each folder above it; MISSING if anything required below is missing."""
    parts = F.split(F.col(path), "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    rows = report.select(entry, (F.col("status") == "missing").alias("m"), F.explode(ups).alias("node"))
    return rows.groupBy(entry, "node").agg(F.when(F.bool_or("m"), "MISSING").otherwise("OK").alias("status"))


def verdict(steps_ok: Column, static_ok: Column, n_missing: Column, metadata_ok: Column) -> Column:
    """FAILED unless all required steps and the static output are ok and no required file is missing; then COMPLETE if the
    metadata step says it is ok, WARNING if it failed or says nothing."""
    whole = F.coalesce(steps_ok, F.lit(False)) & F.coalesce(static_ok, F.lit(False)) & (F.coalesce(n_missing, F.lit(0)) == 0)
    return F.when(~whole, "FAILED").when(F.coalesce(metadata_ok, F.lit(False)), "COMPLETE").otherwise("WARNING")


def run_issues(inputs_ok: Column, failed_steps: Column, static_ok: Column, has_output: Column, missing: Column, errors: Column, steps_ok: Column, metadata_ok: Column) -> Column:
    """The issues of a run in their order, each once: inputs, steps, static output, missing files (arrays of names), other
    errors (those that say missing are told already), and the metadata step."""
    one = lambda when, text: F.when(when, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    each = lambda prefix, names: F.transform(names, lambda x: F.concat(F.lit(prefix), x))
    no = lambda x: ~F.coalesce(x, F.lit(False))
    silent = metadata_ok.isNull() & F.coalesce(steps_ok, F.lit(False)) & F.coalesce(static_ok, F.lit(False))
    return F.array_distinct(
        F.concat(
            one(no(inputs_ok), "[MISSING] input files not found in the data directory"),
            each("[MISSING] step incomplete: ", failed_steps),
            one(no(static_ok), "[MISSING] static step incomplete"),
            one(no(has_output), "[MISSING] static output directory not found"),
            each("[MISSING] ", missing),
            each("[WARN] ", F.filter(errors, lambda x: ~x.startswith("missing "))),
            one(F.coalesce(~metadata_ok, F.lit(False)), "[WARN] metadata step failed"),
            one(silent, "[WARN] metadata step did not report a final status"),
        )
    )


def static_complete(entries: DataFrame, issues: DataFrame, mode: str) -> DataFrame:
    """entries(id, name, accession, sequence) with `complete`: full asks for a name and no row in issues(id); simple for an
    id, and an accession or a sequence."""
    if mode == "full":
        bad = issues.select("id").distinct().withColumn("_bad", F.lit(True))
        return entries.join(bad, "id", "left").withColumn("complete", clean_null(F.col("name")).isNotNull() & F.col("_bad").isNull()).drop("_bad")
    if mode != "simple":
        raise ValueError(f"unknown mode {mode}")
    has = lambda c: clean_null(F.col(c).cast("string")).isNotNull()
    return entries.withColumn("complete", has("id") & (has("accession") | has("sequence")))


def step_rates(status: DataFrame) -> DataFrame:
    """status(mol_id, step, ok) to (step, n, n_ok, pct)."""
    ok = F.sum(F.col("ok").cast("long"))
    return status.groupBy("step").agg(F.count("*").alias("n"), ok.alias("n_ok"), (100.0 * ok / F.count("*")).alias("pct"))


def decide(status: DataFrame, required: Sequence[str], mode: str) -> DataFrame:
    """(mol_id, complete, action) under a mode: incremental runs what is incomplete, refresh gives complete ones their
    metadata, fresh runs all. A molecule is complete if each required step is there and ok."""
    n = F.count_distinct(F.when(F.col("ok") & F.col("step").isin(*required), F.col("step")))
    done = status.groupBy("mol_id").agg((n == len(required)).alias("complete"))
    action = {"incremental": F.when(F.col("complete"), "skip").otherwise("run"), "refresh": F.when(F.col("complete"), "metadata").otherwise("skip"), "fresh": F.lit("run")}[mode]
    return done.withColumn("action", action)


def gated_stages(status: DataFrame, stages: Sequence[str]) -> DataFrame:
    """(mol_id, stage, state): ok or failed as told, blocked after the first stage that isn't ok."""
    order = F.create_map(*(x for i, s in enumerate(stages) for x in (F.lit(s), F.lit(i))))
    rows = status.withColumn("_o", F.try_element_at(order, F.col("stage"))).where("_o is not null")
    before = F.coalesce(F.bool_and("ok").over(W.partitionBy("mol_id").orderBy("_o").rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    return rows.select("mol_id", "stage", F.when(~before, "blocked").when(F.col("ok"), "ok").otherwise("failed").alias("state"))


def search_text(fields: Sequence[Column], lists: Sequence[Column]) -> Column:
    """Fields and lists as lines, of which the first spelling stays; missing ones give no line."""
    none = F.array().cast("array<string>")
    return F.array_join(normal_list(F.concat(F.array(*fields), *(F.coalesce(x, none) for x in lists))), "\n")


def canonical_name(*options: Column) -> Column:
    return F.coalesce(*(clean_null(x) for x in options), F.lit(""))


#: Keywords that say what kind of glycan an entry is.
KINDS = ("N-Glycan", "O-Glycan", "GAG", "Oligomannose", "Complex N-Glycan", "Hybrid N-Glycan", "Biantennary N-Glycan", "Triantennary N-Glycan", "Tetraantennary N-Glycan", "Fucosylated N-Glycan")


def described(ident: Column, name: Column, keywords: Column, package: Column, forcefield: Column, temperature: Column, names: Column, parts: Column, comment: Column) -> Column:
    """Sentences for search: identity, kinds among the keywords, simulation, common names, composition (a map of counts, or
    null) and a comment; what has no value falls out."""
    listed = lambda x: F.array_join(x, ", ")
    some = lambda x: F.when(x.cast("string") != "", x.cast("string"))
    kinds = F.filter(keywords, lambda x: x.isin(*KINDS))
    setup = F.concat_ws(", ", F.concat(F.lit("MD package "), some(package)), F.concat(F.lit("force field "), some(forcefield)), F.concat(temperature.cast("string"), F.lit("K")))
    counts = parts.cast("map<string,string>")
    made = F.array_join(F.transform(F.map_entries(counts), lambda x: F.concat(x.value, F.lit("x "), x.key)), ", ")
    return F.concat_ws(
        " ",
        F.concat(ident, F.lit(" is a glycan with IUPAC notation "), some(name), F.lit(".")),
        F.when(F.size(kinds) > 0, F.concat(F.lit("Classified as: "), listed(kinds), F.lit("."))),
        F.when(setup != "", F.concat(F.lit("Simulated with "), setup, F.lit("."))),
        F.when(F.size(names) > 0, F.concat(F.lit("Also known as: "), listed(names), F.lit("."))),
        F.when(F.size(counts) > 0, F.concat(F.lit("Composed of "), made, F.lit("."))),
        some(comment),
    )
