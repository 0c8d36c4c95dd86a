"""Names of torsions, sugars and storage keys as column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def token(col: Column) -> Column:
    """Letters and digits kept, other runs as one underscore, none at the ends; NA if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(col.cast("string"), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit("NA")).otherwise(out)


def torsion_parts(name: Column) -> Column:
    """array<struct<atom, res>> of `A_1-B_1-C_2-D_2`, null for any other text."""
    parts = F.split(name, "-")
    parsed = F.transform(
        parts,
        lambda p: F.struct(F.regexp_extract(p, "^(.*)_([^_]*)$", 1).alias("atom"), F.regexp_extract(p, "^(.*)_([^_]*)$", 2).try_cast("int").alias("res")),
    )
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: p.contains("_")) & F.forall(parsed, lambda x: x.res.isNotNull())
    return F.when(good, parsed)


def _linkage_class(a: Sequence[Column], r: Sequence[Column]) -> Column:
    joined = lambda x, y, kind: F.concat_ws("_", x.cast("string"), y.cast("string"), F.lit(kind))
    bridging = lambda x: x.startswith("O") & (x != "O5")
    phi = (a[0] == "O5") & (a[1] == "C1") & bridging(a[2]) & a[3].startswith("C") & (r[0] == r[1]) & (r[2] == r[3]) & (r[0] != r[2])
    psi = (a[0] == "C1") & bridging(a[1]) & a[2].startswith("C") & (a[3].startswith("C") | a[3].startswith("O")) & (r[0] == r[1]) & (r[1] != r[2]) & (r[2] == r[3])
    omega = bridging(a[0]) & (a[1] == "C6") & (a[2] == "C5") & (a[3] == "O5") & (r[1] == r[2]) & (r[2] == r[3]) & (r[0] != r[1])
    return F.when(phi, joined(r[0], r[2], "phi")).when(psi, joined(r[0], r[2], "psi")).when(omega, joined(r[0], r[1], "omega"))


def glycosidic_class(name: Column) -> Column:
    """phi, psi or omega with its residues, read forwards, else backwards; else other_ and the name."""
    parts = torsion_parts(name)
    atoms, residues = [parts[i].atom for i in range(4)], [parts[i].res for i in range(4)]
    return F.coalesce(_linkage_class(atoms, residues), _linkage_class(atoms[::-1], residues[::-1]), F.concat(F.lit("other_"), name))


def canonical_order(atoms: Sequence[Column], ids: Sequence[Column], names: Sequence[Column]) -> Column:
    """True if the torsion reads backwards in its canonical form: the smaller of both keys wins."""

    def key(order: Sequence[int]) -> Column:
        a, b, c, d = order
        part = lambda tag, i: F.concat_ws("_", F.lit(tag), ids[i].cast("string"), token(names[i]), token(atoms[i]))
        return F.array(part("c0", b), part("c1", c), part("f0", a), part("f1", d))

    return key((3, 2, 1, 0)) < key((0, 1, 2, 3))


def canonical_name(atoms: Sequence[Column], ids: Sequence[Column], names: Sequence[Column]) -> Column:
    part = lambda i: F.concat(F.lit("r"), F.concat_ws("_", ids[i].cast("string"), token(names[i]), token(atoms[i])))
    spelled = lambda order: F.concat_ws("__", *(part(i) for i in order))
    return F.when(canonical_order(atoms, ids, names), spelled((2, 1, 3, 0))).otherwise(spelled((1, 2, 0, 3)))


def local_identity(atoms: Sequence[Column], ids: Sequence[Column]) -> Column:
    """struct<family, subtype, common_name> of a torsion that is not glycosidic."""
    centre = F.array_sort(F.array(atoms[1], atoms[2]))
    is_pair = lambda x, y: centre == F.array(F.lit(min(x, y)), F.lit(max(x, y)))
    every = F.array(*atoms)
    bond = F.concat_ws("_", F.lit("bond"), token(atoms[1]), token(atoms[2]))
    named = (
        F.when(is_pair("C5", "C6") & F.array_contains(every, "C4") & F.array_contains(every, "O6"), "exocyclic_c6")
        .when(is_pair("C2", "N2"), "n_acetyl_linker")
        .when(is_pair("N2", "C7"), "n_acetyl_amide")
        .when(is_pair("C7", "C8"), "n_acetyl_methyl")
    )
    local = ids[1] == ids[2]
    subtype = F.when(local, F.coalesce(named, bond)).otherwise(bond)
    common = F.when(local & named.startswith("n_acetyl"), "n_acetyl").when(local & (named == "exocyclic_c6"), "exocyclic_c6")
    return F.struct(F.when(local, "residue_local").otherwise("inter_residue").alias("family"), subtype.alias("subtype"), common.alias("common_name"))


def tidy_name(name: Column) -> Column:
    """struct<tidy, end_pos, end_link>: a name ending in -OH loses its last five signs, two of which are kept apart."""
    ends = name.endswith("-OH")
    return F.struct(
        F.when(ends, F.substring(name, F.lit(1), F.length(name) - 5)).otherwise(name).alias("tidy"),
        F.when(ends, F.substring(name, -4, 1)).alias("end_pos"),
        F.when(ends, F.substring(name, -5, 1)).alias("end_link"),
    )


def anomer(name: Column) -> Column:
    last = F.element_at(F.regexp_extract_all(name, F.lit("[A-Za-z0-9]+-?OH?"), F.lit(0)), -1)
    has = lambda x: last.contains(f"{x}1-OH") | last.contains(f"{x}2-OH")
    found = F.size(F.regexp_extract_all(name, F.lit("[A-Za-z0-9]+-?OH?"), F.lit(0))) > 0
    return F.when(found, F.when(has("a"), "alpha").when(has("b"), "beta").otherwise("unknown")).otherwise("unknown")


def without_series(name: Column) -> Column:
    """A name without its D- and L- marks."""
    return F.replace(F.replace(name, F.lit("D-"), F.lit("")), F.lit("L-"), F.lit(""))


def anomer_variants(condensed: Column, tidy: Column, end_pos: Column) -> Column:
    """struct of both anomers' condensed and full names."""
    short = lambda x: F.concat(condensed, F.lit(f"({x}"), end_pos, F.lit("-"))
    full = lambda x: F.concat(tidy, F.lit(x), end_pos, F.lit("-OH"))
    return F.struct(short("a").alias("alpha_short"), short("b").alias("beta_short"), full("a").alias("alpha_full"), full("b").alias("beta_full"))


def composition(condensed: Column) -> Column:
    """array<struct<residue, n>> of a condensed name: brackets off, linkages as separators; by falling count,
    ties by first place."""
    parts = F.split(F.regexp_replace(F.regexp_replace(condensed, r"\[|\]", ""), r"\(.*?\)", "."), r"\.")
    counted = F.transform(F.array_distinct(parts), lambda x: F.struct((-F.size(F.filter(parts, lambda y: y == x))).alias("n"), F.array_position(parts, x).alias("at"), x.alias("residue")))
    return F.transform(F.array_sort(counted), lambda x: F.struct(x.residue.alias("residue"), (-x.n).alias("n")))


#: Ring bond and anomer marks of a sequence's first residue, and the kind each tells.
SEQUENCE_KINDS = (("alpha", "-1a_"), ("beta", "-1b_"), ("neutral", "-1x_"))


def sequence_variants(sequence: Column) -> Column:
    """struct<kind, archetype, alpha, beta> of a sequence of the form header/residues/linkage/annotation; null
    if it has another form. Only the first residue differs between the three."""
    form = r"^(WURCS=2\.0/\d+,\d+,\d+/)(\[.*?\]+)(/[^/]*/[^/]*)$"
    head, residues, tail = (F.regexp_extract(sequence, form, i) for i in (1, 2, 3))
    first, others = F.regexp_extract(residues, r"^\[([^\]]+)\]", 1), F.regexp_replace(residues, r"^\[[^\]]+\]", "")
    kind = F.when(first.rlike("^[uU]"), "archetype")
    for name, mark in SEQUENCE_KINDS:
        kind = kind.when(first.contains(mark), name)
    anomeric = r"^a(\w+)-1[abx]_(\d+-\d+)(.*)$"
    open_form = r"^[uU](\w+)(.*)$"
    is_open = kind == "archetype"
    body = F.when(is_open, F.regexp_extract(first, open_form, 1)).otherwise(F.regexp_extract(first, anomeric, 1))
    ring = F.when(is_open, F.lit("1-5")).otherwise(F.regexp_extract(first, anomeric, 2))
    rest = F.when(is_open, F.regexp_extract(first, open_form, 2)).otherwise(F.regexp_extract(first, anomeric, 3))
    whole = lambda residue: F.concat(head, F.lit("["), residue, F.lit("]"), others, tail)
    closed = lambda x: whole(F.concat(F.lit("a"), body, F.lit(f"-1{x}_"), ring, rest))
    archetype = F.when(is_open, sequence).otherwise(whole(F.concat(F.lit("u"), body, rest)))
    own = lambda name, made: F.when(kind == name, sequence).otherwise(made)
    return F.when(
        (head != "") & kind.isNotNull() & (body != ""),
        F.struct(kind.alias("kind"), archetype.alias("archetype"), own("alpha", closed("a")).alias("alpha"), own("beta", closed("b")).alias("beta")),
    )


def fallback_id(name: Column) -> Column:
    return F.concat(F.lit("GS"), F.upper(F.substring(F.md5(name.cast("binary")), 1, 6)))


def storage_key(path: Column) -> Column:
    return F.rtrim(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/"))


def first_segment(path: Column, prefix: Column) -> Column:
    return F.element_at(F.split(F.substring(storage_key(path), F.length(prefix) + 1, F.length(path)), "/"), 1)


def keyword_label(col: Column) -> Column:
    return F.translate(F.lower(col), " -", "__")


def terminus_label(col: Column) -> Column:
    return F.translate(col, "()-", "___")


def sequence_label(col: Column) -> Column:
    return F.replace(F.translate(F.translate(F.lower(col), "()", ""), " ", "_"), F.lit("/"), F.lit("_"))


def cluster_label(col: Column) -> Column:
    return F.translate(col, " ", "_")


#: Residue codes without their first sign, and what two other schemes call them.
PDB_NAMES = {
    "YA": "NDG", "YB": "NAG", "VA": "A2G", "VB": "NGA", "GA": "GLC", "GB": "BGC", "GL": "NGC", "LA": "GLA", "LB": "GAL", "fA": "FUC", "fB": "FUL", "MB": "BMA", "MA": "MAN",
    "SA": "SIA", "ZA": "GCU", "ZB": "BDP", "XA": "XYS", "XB": "XYP", "uA": "IDR", "hA": "RAM", "hB": "RHM", "RA": "RIB", "RB": "BDR", "AA": "ARA", "AB": "ARB",
}
CHARMM_NAMES = {
    "YA": "AGLC", "YB": "BGLC", "VA": "AGAL", "VB": "BGAL", "GA": "AGLC", "GB": "BGLC", "LA": "AGAL", "LB": "BGAL", "fA": "FUC", "fB": "FUC", "MA": "AMAN", "MB": "BMAN",
    "SA": "ANE5", "GL": "ANE5", "XA": "AXYL", "XB": "BXYL", "uA": "AIDO", "ZA": "AGLC", "ZB": "BGLC", "hA": "ARHM", "hB": "BRHM", "AA": "AARB", "AB": "BARB", "RA": "ARIB", "RB": "BRIB",
}


def renamed_residue(residue: Column, scheme: str) -> Column:
    """A residue's name in another scheme (GLYCAM, PDB or CHARMM), by one lookup of its last two signs, so no
    name is renamed twice; others stay."""
    if scheme == "GLYCAM":
        return residue
    if scheme not in ("PDB", "CHARMM"):
        raise ValueError(f"unknown scheme {scheme}")
    names = F.create_map(*(F.lit(x) for pair in (PDB_NAMES if scheme == "PDB" else CHARMM_NAMES).items() for x in pair))
    return F.when(residue.rlike(r"^\w\w\w$"), F.coalesce(F.try_element_at(names, F.substring(residue, 2, 2)), residue)).otherwise(residue)


#: Sugars and their usual series.
SERIES = {
    "D": (
        "4eLeg", "6dGul", "6dTal", "6dTalNAc", "8eAci", "Abe", "All", "AllA", "AllN", "AllNAc", "Bac", "Col",
        "DDmanHep", "Dha", "Dig", "Fru", "Gal", "GalA", "GalN", "GalNAc", "Glc", "GlcA", "GlcN", "GlcNAc", "Gul",
        "GulA", "GulN", "GulNAc", "Kdn", "Kdo", "Leg", "Lyx", "Man", "ManA", "ManN", "ManNAc", "Mur", "MurNAc",
        "MurNGc", "Neu", "Neu5Ac", "Neu5Gc", "Oli", "Par", "Psi", "Qui", "QuiNAc", "Rib", "Sia", "Tag", "Tal", "TalA",
        "TalN", "TalNAc", "Tyv", "Xyl",
    ),
    "L": (
        "6dAlt", "6dAltNAc", "8eLeg", "Aci", "Alt", "AltA", "AltN", "AltNAc", "Api", "Ara", "Fuc", "FucNAc", "Ido",
        "IdoA", "IdoN", "IdoNAc", "LDmanHep", "Pse", "Rha", "RhaNAc", "Sor",
    ),
}
#: Spellings of substituents and acids, in the order in which they are replaced.
SUBSTITUENTS = (
    ("[2S]", "2S"), ("[3S]", "3S"), ("[4S]", "4S"), ("[6S]", "6S"), ("[3S-6S]", "3S6S"), ("[3S,6S]", "3S6S"), ("[4S,6S]", "4S6S"), ("[2Me]", "2Me"), ("[2Me-3Me]", "2Me3Me"), ("[2Me,3Me]", "2Me3Me"),
    ("[2Me-4Me]", "2Me4Me"), ("[2Me,4Me]", "2Me4Me"), ("[2Me-6Me]", "2Me6Me"), ("[2Me,6Me]", "2Me6Me"), ("[2Me-3Me-4Me]", "2Me3Me4Me"), ("[2Me,3Me,4Me]", "2Me3Me4Me"), ("[3Me]", "3Me"), ("[4Me]", "4Me"),
    ("[6Me]", "6Me"), ("[9Me]", "9Me"), ("[2A]", "2Ac"), ("[4A]", "4Ac"), ("[9A]", "9Ac"), ("[6PC]", "6Pc"), ("DKDN", "Kdn"), ("DKDO", "Kdo"), ("LKDN", "LKdn"), ("LKDO", "LKdo"),
)
SPECIAL_NAMES = {"DGalpb1-4DGalpa1-3[2,4-diacetimido-2,4,6-trideoxyhexose]": "Gal(b1-4)Gal(a1-3)2,4-diacetimido-2,4,6-trideoxyhexose"}


def condensed_name(full: Column) -> Column:
    """A full residue-by-residue name in the condensed form: usual series unmarked, ring marks off, linkages in
    parentheses, substituents respelled."""
    parts = F.split(full, "-")
    last = F.size(parts) - 1

    def component(part: Column, at: Column) -> Column:
        # a component's usual series decides which of both marks goes and which is spelled out
        holds = lambda names: F.greatest(*(part.contains(x) for x in names))
        d_series = F.replace(F.replace(part, F.lit("D"), F.lit("")), F.lit("L"), F.lit("L-"))
        l_series = F.replace(F.replace(part, F.lit("L"), F.lit("")), F.lit("D"), F.lit("D-"))
        out = F.when(holds(SERIES["D"]), d_series).when(holds(SERIES["L"]), l_series).otherwise(part)
        out = F.replace(out, F.lit("p"), F.lit(""))
        link = F.substring(out, -2, 2)
        at_link = F.call_function("instr", out, link)
        linked = F.concat(F.substring(out, F.lit(1), at_link - 1), F.lit("("), link, F.lit("-"), F.substring(out, at_link + 2, F.length(out)))
        out = F.when((at < last) & (F.length(out) >= 2), linked).otherwise(out)
        out = F.when((at > 0) & (F.length(out) >= 1), F.concat(F.substring(out, 1, 1), F.lit(")"), F.substring(out, F.lit(2), F.length(out)))).otherwise(out)
        for old, new in SUBSTITUENTS:
            out = F.replace(out, F.lit(old), F.lit(new))
        return out

    made = F.array_join(F.transform(parts, component), "")
    for name, special in SPECIAL_NAMES.items():
        made = F.when(full == name, F.lit(special)).otherwise(made)
    return made
