"""Search metadata of entries: names, aliases, accession repair, enrichment and the record to be upserted.

An entry is a row with id, three structs of texts (archetype, alpha, beta; each may be null, each may lack
fields) and its search metadata so far: keywords and common_names (arrays) and description.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.functions.columns import clean_null, normal_list
from sugarloom.functions.keywords import keywords
from sugarloom.operators.records import canonical_name, described

FORMS = ("archetype", "alpha", "beta")
#: The fields of a form that are kept as name variants, and those that are aliases.
VARIANT_FIELDS = ("name", "glycam", "iupac", "iupac_extended", "glytoucan", "wurcs", "oxford")
ALIAS_FIELDS = ("name", "glycam", "iupac", "iupac_extended", "oxford")
#: Common names of gangliosides by accession.
GANGLIOSIDES = {
    "G40990LB": "GA2",
    "G00071MO": "GA1",
    "G01269WV": "GM1b",
    "G86874EI": "GD1c",
    "G40764VP": "GM3",
    "G65156XZ": "GM2",
    "G41876BL": "GM1b",
    "G21518JT": "GD1a",
    "G97898ZO": "GT1a",
    "G10158SF": "GD3",
    "G98397EB": "GD2",
    "G08648UJ": "GT1b",
    "G71158TZ": "GQ1b",
    "G27476OM": "GT3",
    "G66281XG": "GT2",
    "G53140PB": "GT1c",
    "G54434YJ": "GQ1c",
    "G44362TS": "GP1c",
}


def no_texts() -> Column:
    return F.array().cast("array<string>")


def _fields(form: str, names: Sequence[str], have: Sequence[str]) -> list[tuple[str, Column]]:
    return [(x, F.col(f"{form}.{x}").cast("string")) for x in names if x in have]


def fields_of(entries: DataFrame) -> list[str]:
    """The fields of the forms; all three have the same."""
    return [f.name for f in entries.schema["archetype"].dataType.fields]


def common_names(entries: DataFrame) -> Column:
    """Sorted: the archetype's short notation, and the name that any form's accession has."""
    have = fields_of(entries)
    known = F.create_map(*(F.lit(x) for pair in GANGLIOSIDES.items() for x in pair))
    by_accession = [F.try_element_at(known, F.col(f"{form}.glytoucan")) for form in FORMS] if "glytoucan" in have else []
    short = [F.col("archetype.oxford")] if "oxford" in have else []
    return F.array_sort(F.array_distinct(F.filter(F.array(*short, *by_accession), lambda x: x.isNotNull() & (x != ""))))


def name_variants(entries: DataFrame) -> Column:
    """map of form to map of field to trimmed text; empty fields and forms fall out."""
    have = fields_of(entries)

    def of(form: str) -> Column:
        pairs = _fields(form, VARIANT_FIELDS, have)
        whole = F.map_from_arrays(F.array(*(F.lit(k) for k, _ in pairs)), F.array(*(F.trim(v) for _, v in pairs)))
        return F.map_filter(whole, lambda k, v: v.isNotNull() & (v != ""))

    forms = F.map_from_arrays(F.array(*map(F.lit, FORMS)), F.array(*map(of, FORMS)))
    return F.map_filter(forms, lambda k, v: F.size(v) > 0)


def aliases(entries: DataFrame, names: Column) -> Column:
    """The names of all forms and then the common ones; of those equal but for case the first stays."""
    have = fields_of(entries)
    own = [v for form in FORMS for _, v in _fields(form, ALIAS_FIELDS, have)]
    return normal_list(F.concat(F.array(*own), F.coalesce(names, no_texts())))


def chosen_name(entries: DataFrame, names: Column) -> Column:
    """The short notation, else the first common name, else the archetype's best name, else its id."""
    have = fields_of(entries)
    get = lambda x: F.col(f"archetype.{x}") if x in have else F.lit(None)
    return canonical_name(get("oxford"), F.get(names, F.lit(0)), *(get(x) for x in ("iupac_extended", "iupac", "name", "glycam")), F.col("id").cast("string"))


# -- short notation -----------------------------------------------------------------------------------

_PART = re.compile(r"\[|\]|[^\[\]()]+(?:\([^)]*\))?")


def branch_key(name: str | None) -> str | None:
    """A condensed name with its branches in sorted order: equal for equal structures, however branches are written."""
    if not name:
        return None
    # parts and their parents in the order of their making, so every part comes after the one that it hangs on
    parts, parents, at, held = [""], [0], 0, []
    for part in reversed(_PART.findall(name)):
        if part == "]":
            held.append(at)
        elif part == "[":
            at = held.pop() if held else at
        else:
            parts.append(part)
            parents.append(at)
            at = len(parts) - 1
    below: list[list[str]] = [[] for _ in parts]
    for i in range(len(parts) - 1, -1, -1):
        spelled = parts[i] + "{" + ",".join(sorted(below[i])) + "}"
        below[i].clear()
        if i:
            below[parents[i]].append(spelled)
    return spelled


def with_branch_key(rows: DataFrame, name: str, out: str) -> DataFrame:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(branch_key, na_action="ignore")

    return rows.withColumn(out, F.pandas_udf(run, "string")(F.col(name)))


def short_notation(rows: DataFrame, catalogue: DataFrame, name: str = "iupac", out: str = "oxford") -> DataFrame:
    """rows with the notation of the first entry of catalogue(place, notation, condensed) whose name has the same length
    and structure."""
    first = with_branch_key(catalogue, "condensed", "_key").groupBy("_key", F.length("condensed").alias("_length")).agg(F.min_by("notation", "place").alias(out))
    keyed = with_branch_key(rows, name, "_key").withColumn("_length", F.length(name))
    return keyed.join(first, ["_key", "_length"], "left").drop("_key", "_length")


# -- repair, enrichment, update -------------------------------------------------------------------------


def repaired(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """entries whose forms without an accession get that of registry(wurcs, glytoucan) by their sequence, and `repairs`:
    of each form given, resolved, still_missing or unasked (no sequence). Of a sequence's accessions the least counts."""
    known = registry.where(clean_null(F.col("glytoucan")).isNotNull()).groupBy(F.trim("wurcs").alias("_wurcs")).agg(F.min(F.trim("glytoucan")).alias("_found"))
    out = entries
    for form in FORMS:
        own, sequence = clean_null(F.col(f"{form}.glytoucan")), clean_null(F.col(f"{form}.wurcs"))
        out = out.withColumn("_wurcs", F.when(own.isNull(), sequence)).join(known, "_wurcs", "left")
        said = F.when(own.isNotNull(), "given").when(sequence.isNull(), "unasked").when(F.col("_found").isNotNull(), "resolved").otherwise("still_missing")
        fixed = F.when(F.col(form).isNotNull(), F.col(form).withField("glytoucan", F.coalesce(F.col("_found"), F.col(f"{form}.glytoucan"))))
        out = out.withColumn(f"_{form}", said).withColumn(form, fixed).drop("_wurcs", "_found")
    repairs = F.create_map(*(x for form in FORMS for x in (F.lit(form), F.col(f"_{form}"))))
    return out.withColumn("repairs", repairs).drop(*(f"_{form}" for form in FORMS))


def enriched(entries: DataFrame, curated: DataFrame, submissions: DataFrame) -> DataFrame:
    """entries with what curated(id, keywords, common_names, description) and submissions(id, md_package, force_field,
    source_type, comments) add: keywords and names are only added to, a curated description wins, and one is
    written where there is none. Entries in neither table stay. Of a repeated id its least row counts."""
    once = lambda df, name: df.groupBy("id").agg(F.min(F.struct(*(c for c in df.columns if c != "id"))).alias(name))
    both = entries.join(once(curated, "_c"), "id", "left").join(once(submissions, "_s"), "id", "left")
    tag = lambda prefix, field: F.when(F.trim(F.col(f"_s.{field}")) != "", F.concat(F.lit(prefix), F.trim(F.col(f"_s.{field}"))))
    extra = F.concat(F.coalesce(F.col("_c.keywords"), no_texts()), F.array(tag("MD:", "md_package"), tag("FF:", "force_field"), tag("Source:", "source_type")))
    extra = F.filter(extra, lambda x: x.isNotNull() & (x != ""))
    known = F.col("_c").isNotNull() | F.col("_s").isNotNull()
    added = lambda old, new: F.when(F.size(new) > 0, F.array_sort(F.array_union(F.coalesce(old, no_texts()), new))).otherwise(old)
    out = both.withColumns({"keywords": added(F.col("keywords"), extra), "common_names": added(F.col("common_names"), normal_list(F.coalesce(F.col("_c.common_names"), no_texts())))})
    have = fields_of(entries)
    get = lambda x: F.col(f"archetype.{x}") if x in have else F.lit(None)
    sentence = described(F.col("id").cast("string"), get("iupac"), F.col("keywords"), get("package"), get("forcefield"), get("temperature"), F.col("common_names"), get("components"), F.trim(F.col("_s.comments")))
    written = F.coalesce(F.when(F.trim(F.col("_c.description")) != "", F.trim(F.col("_c.description"))), F.when(F.col("description") != "", F.col("description")), sentence)
    return out.withColumn("description", F.when(known, written).otherwise(F.col("description"))).drop("_c", "_s")


def updated(entries: DataFrame, registry: DataFrame, curated: DataFrame, submissions: DataFrame) -> DataFrame:
    """All entries with repaired accessions, the keywords of their condensed names, their common names and what the
    curated tables add, in one plan; `repairs` as in repaired()."""
    out = repaired(entries, registry)
    ruled = F.array_sort(F.array_union(F.coalesce("keywords", no_texts()), keywords(F.col("archetype.iupac"))))
    out = out.withColumns({"keywords": F.when(F.col("archetype.iupac") != "", ruled).otherwise(F.col("keywords")), "common_names": F.array_sort(F.array_union(F.coalesce("common_names", no_texts()), common_names(out)))})
    return enriched(out, curated, submissions)


def update_counts(entries: DataFrame) -> DataFrame:
    """(what, n) over updated entries: how many there are, and their forms by what repaired() says."""
    long = entries.select(F.explode(F.concat(F.array(F.lit("entries")), F.map_values("repairs"))).alias("what"))
    return long.groupBy("what").agg(F.count("*").alias("n"))


def payload(entries: DataFrame) -> DataFrame:
    """The record of each entry with an id: names, accession, variants, aliases, keywords and description; texts trimmed and
    never null."""
    text = lambda *options: F.coalesce(*(F.when(F.trim(x) != "", F.trim(x)) for x in options), F.lit(""))
    have = fields_of(entries)
    get = lambda x: F.col(f"archetype.{x}") if x in have else F.lit("")
    names = normal_list(F.coalesce("common_names", no_texts()))
    return entries.where(F.trim(F.col("id").cast("string")) != "").select(
        F.trim(F.col("id").cast("string")).alias("id"),
        chosen_name(entries, names).alias("canonical_name"),
        text(get("name"), get("glycam")).alias("glycam_name"),
        text(get("iupac_extended"), get("iupac")).alias("iupac_name"),
        text(get("glytoucan")).alias("accession"),
        name_variants(entries).alias("name_variants"),
        aliases(entries, names).alias("aliases"),
        names.alias("common_names"),
        normal_list(F.coalesce("keywords", no_texts())).alias("keywords"),
        text(F.col("description")).alias("description"),
    )


def metadata_issues(entries: DataFrame, has_metadata: Column) -> DataFrame:
    """(id, issue): missing_search_meta, or else missing_keywords and invalid_iupac."""
    none = ~F.coalesce(has_metadata, F.lit(False))
    bare = ~none & (F.coalesce(F.size("keywords"), F.lit(0)) <= 0)
    unnamed = ~none & (F.coalesce(F.col("archetype.iupac"), F.lit("")) == "")
    found = F.array(F.when(none, "missing_search_meta"), F.when(bare, "missing_keywords"), F.when(unnamed, "invalid_iupac"))
    return entries.select("id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("issue"))


def issue_counts(issues: DataFrame) -> DataFrame:
    """(issue, n) of issues(id, issue), and their total under `all`."""
    return issues.select(F.explode(F.array("issue", F.lit("all"))).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
