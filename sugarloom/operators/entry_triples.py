"""The triples of entry documents: entries and their forms, names, sequences, parts, simulation and clusters.

documents are rows (entry, archetype, alpha, beta, search_meta); the forms are structs that may be null and may
lack any field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.operators import triples as t

FORMS = {"archetype": ("onto:Archetype", "onto:hasArchetype"), "alpha": ("onto:AlphaAnomer", "onto:hasAlphaAnomer"), "beta": ("onto:BetaAnomer", "onto:hasBetaAnomer")}
#: Field, format and label of the sequence forms; formats of our own get labels too.
SEQUENCES = (
    ("wurcs", "rdfg:carbohydrate_format_wurcs", "WURCS"),
    ("glycoct", "rdfg:carbohydrate_format_glycoct", "GlycoCT"),
    ("iupac", "rdfg:carbohydrate_format_iupac_condensed", "IUPAC Condensed"),
    ("iupac_extended", "onto:carbohydrate_format_iupac_extended", "IUPAC Extended"),
    ("glycam", "onto:carbohydrate_format_glycam", "GLYCAM"),
    ("smiles", "onto:carbohydrate_format_smiles", "SMILES"),
)
NAMES = (("iupac", "onto:iupacName"), ("iupac_extended", "onto:iupacExtendedName"), ("glycam", "onto:glycamName"), ("oxford", "onto:oxfordName"))
NUMBERS = (("mass", "onto:mass", "double"), ("hbond_acceptor", "onto:hydrogenBondAcceptors", "integer"), ("hbond_donor", "onto:hydrogenBondDonors", "integer"), ("rot_bonds", "onto:rotatableBonds", "integer"), ("entropy", "onto:entropy", "double"))
QUANTITIES = (("length", "onto:simulationLength", "unit:MicroSec", "onto:SimulationTime"), ("temperature", "onto:simulationTemperature", "unit:K", "onto:Temperature"), ("pressure", "onto:simulationPressure", "unit:BAR", "onto:Pressure"))


def _some(x: Column) -> Column:
    return F.when(x.cast("string") != "", x.cast("string"))


def _labels(s: Column, text: Column, *predicates: str) -> list[Column]:
    return [t.literal(s, p, _some(text), "string") for p in predicates]


def _concept(node: Column, text: Column, *kinds: str) -> list[Column]:
    return [*(t.uri(node, "rdf:type", k) for k in (*kinds, "skos:Concept")), *_labels(node, text, "rdfs:label", "skos:prefLabel")]


def _when(there: Column, rows: list[Column]) -> list[Column]:
    return [F.when(there, x) for x in rows]


def metadata_triples(documents: DataFrame) -> DataFrame:
    """Common names, description and keywords of each entry; a concept's triples come with each entry that has it."""
    me = F.concat(F.lit("entry:"), F.col("entry").cast("string"))
    told = documents.select(me.alias("me"), "search_meta.*")
    word = F.col("word")
    names = t.emit(told.select("me", F.explode("common_names").alias("word")), _labels(F.col("me"), word, "skos:altLabel", "onto:commonName"), repeats=True)
    about = t.emit(told, _labels(F.col("me"), F.col("description"), "dcterms:description", "rdfs:comment"), repeats=True)
    node = F.concat(F.lit("keyword/"), F.regexp_replace(F.lower(word), "[ -]", "_"))
    keywords = t.emit(told.select("me", F.explode("keywords").alias("word")).where("word <> ''"), [t.uri(F.col("me"), "dcterms:subject", node), *_concept(node, word)], repeats=True)
    return names.unionByName(about).unionByName(keywords)


def form_triples(documents: DataFrame, form: str) -> DataFrame:
    """What one form of each entry says of itself; what it says of other things may be there many times."""
    have = {f.name for f in documents.schema[form].dataType.fields}
    rows = documents.where(F.col(form).isNotNull()).select(F.concat(F.lit("entry:"), F.col("entry").cast("string"), F.lit(f"/{form}")).alias("me"), f"{form}.*")
    me, get = F.col("me"), lambda x: F.col(x) if x in have else F.lit(None).cast("string")
    out = [t.uri(me, "rdf:type", "onto:Variant"), t.uri(me, "rdf:type", "rdfg:Saccharide")]
    accession = _some(get("glytoucan"))
    out += [*_labels(me, accession, "onto:accession", "dcterms:identifier"), F.when(accession.isNotNull(), t.uri(me, "owl:sameAs", F.concat(F.lit("accession/"), accession)))]
    out += _labels(me, get("name"), "rdfs:label", "dcterms:title", "skos:prefLabel")
    for field, p in NAMES:
        out += _labels(me, get(field), p, "skos:altLabel")
    for field, form_of, label in SEQUENCES:
        value = _some(get(field))
        node = F.concat(me, F.lit("/sequence/" + label.lower().replace(" ", "_")))
        own = [t.uri(me, "rdfg:has_glycosequence", node), t.uri(node, "rdf:type", "rdfg:Glycosequence"), t.literal(node, "rdfg:has_sequence", value, "string"), t.uri(node, "rdfg:in_carbohydrate_format", form_of)]
        if form_of.startswith("onto:"):
            own += _labels(F.lit(form_of), F.lit(label), "rdfs:label", "dcterms:title")
        out += _when(value.isNotNull(), own)
    for field, p, kind in NUMBERS:
        out.append(t.literal(me, p, get(field), kind))
    out += [*_labels(me, get("package"), "onto:simulationPackage"), *_labels(me, get("forcefield"), "onto:simulationForcefield")]
    for field, p, unit, kind in QUANTITIES:
        out += t.quantity(me, p, get(field), unit, kind)
    # a salt that is no number stays a plain text
    salt = F.trim(get("salt").cast("string")).try_cast("double")
    out += [*t.quantity(me, "onto:simulationSaltConcentration", salt, "unit:MilliM", "onto:Concentration"), F.when(salt.isNull(), t.literal(me, "onto:simulationSaltConcentration", _some(get("salt")), "string"))]
    found = t.emit(rows, out, repeats=True)
    for field, make in PARTS.items():
        if field in have:
            found = found.unionByName(make(rows, field))
    return found


def _motifs(rows: DataFrame, field: str) -> DataFrame:
    each = rows.select("me", F.explode(field).alias("m")).select("me", F.col("m.motif").cast("string").alias("id"), F.col("m.motif_label").alias("label")).where("id <> ''")
    node = F.concat(F.lit("motif/"), F.col("id"))
    return t.emit(each, [t.uri(F.col("me"), "rdfg:has_motif", node), *_concept(node, F.col("label"), "rdfg:Motif"), t.literal(node, "dcterms:identifier", F.col("id"), "string")], repeats=True)


def _termini(rows: DataFrame, field: str) -> DataFrame:
    each = rows.select("me", F.explode(field).alias("x")).where("x <> ''")
    node = F.concat(F.lit("terminus/"), F.regexp_replace("x", "[()-]", "_"))
    return t.emit(each, [t.uri(F.col("me"), "rdfg:has_terminal_residue", node), *_concept(node, F.col("x"), "onto:TerminalResidue")], repeats=True)


def _counts(p: str, kind: str, thing_p: str, thing: str, thing_kind: str, count_p: str):
    def make(rows: DataFrame, field: str) -> DataFrame:
        each = rows.select("me", F.explode(field).alias("name", "n"))
        node, what = t.blank(F.col("me"), F.lit(p), F.col("name")), F.concat(F.lit(thing + "/"), F.col("name"))
        return t.emit(each, [t.linked(F.col("me"), p, node), t.uri(node, "rdf:type", kind), t.uri(node, thing_p, what), *_concept(what, F.col("name"), thing_kind), t.literal(node, count_p, F.col("n"), "integer")], repeats=True)

    return make


def _clusters(p: str, kind: str, share_p: str):
    def make(rows: DataFrame, field: str) -> DataFrame:
        each = rows.select("me", F.explode(field).alias("name", "share"))
        node = t.blank(F.col("me"), F.lit(p), F.col("name"))
        return t.emit(each, [t.linked(F.col("me"), p, node), t.uri(node, "rdf:type", kind), *_labels(node, F.col("name"), "rdfs:label"), *_labels(node, F.replace("name", F.lit(" "), F.lit("_")), "onto:clusterLabel"), t.literal(node, "rdf:value", F.col("share"), "double"), t.literal(node, share_p, F.col("share"), "double")], repeats=True)

    return make


PARTS = {
    "motifs": _motifs,
    "termini": _termini,
    "components": _counts("rdfg:has_component", "rdfg:Component", "rdfg:has_monosaccharide", "monosaccharide", "rdfg:Monosaccharide", "rdfg:has_cardinality"),
    "composition": _counts("onto:hasResidueTypeComposition", "onto:ResidueTypeComposition", "onto:hasResidueType", "residue_type", "onto:ResidueType", "onto:hasCount"),
    "clusters": _clusters("onto:hasClusterResult", "onto:ClusterResult", "onto:clusterPercentage"),
    "coverage_clusters": _clusters("onto:hasCoverageClusterResult", "onto:CoverageClusterResult", "onto:coveragePercentage"),
}


def entry_triples(documents: DataFrame) -> DataFrame:
    """All triples of all entries, each once: repeats fall out in one step, after all kinds are made."""
    me = F.concat(F.lit("entry:"), F.col("entry").cast("string"))
    ident, title = F.col("entry").cast("string"), F.concat(F.lit("Entry "), F.col("entry").cast("string"))
    links = [t.uri(me, "rdf:type", "onto:Entry"), t.uri(me, "rdf:type", "skos:Concept"), *_labels(me, title, "rdfs:label", "dcterms:title"), *_labels(me, ident, "dcterms:identifier", "onto:id")]
    first = F.concat(me, F.lit("/archetype"))
    for form, (kind, p) in FORMS.items():
        own = F.concat(me, F.lit(f"/{form}"))
        there = F.col(form).isNotNull()
        links += _when(there, [t.uri(me, "onto:hasVariant", own), t.uri(own, "rdf:type", kind), t.uri(me, p, own)])
        if form != "archetype":
            links.append(F.when(there & F.col("archetype").isNotNull(), t.uri(own, "onto:isAnomerOf", first)))
    out = t.emit(documents, links, repeats=True).unionByName(metadata_triples(documents))
    for form in FORMS:
        out = out.unionByName(form_triples(documents, form))
    return out.distinct()
