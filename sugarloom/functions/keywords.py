"""Keyword rules over condensed names, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cores, arms and patterns that tell the classes apart.
CORE = "Man(b1-4)GlcNAc(b1-4)GlcNAc"
FUCOSYLATED_CORE = "Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc"
CORES = (CORE, FUCOSYLATED_CORE, "Man(b1-4)GlcNAc(b1-4)[Fuc(a1-3)]GlcNAc")
NOT_OLIGOMANNOSE = ("GlcNAc(b1-2)Man", "Gal(", "Neu5Ac(", "Xyl(", "GlcNAc(b1-4)]Man", "GlcNAc(b1-6)[GlcNAc(b1-2)]Man", "GlcNAc(b1-4)[GlcNAc(b1-2)]Man")
ARM_3 = ("GlcNAc(b1-2)Man(a1-3)", "GlcNAc(b1-2)]Man(a1-3)")
ARM_6 = ("GlcNAc(b1-2)Man(a1-6)", "GlcNAc(b1-2)]Man(a1-6)")
ARM_3_MORE = ("GlcNAc(b1-4)Man(a1-3)", "GlcNAc(b1-4)[Man(a1-3)", "GlcNAc(b1-4)[GlcNAc(b1-2)]Man(a1-3)")
ARM_6_MORE = ("GlcNAc(b1-6)Man(a1-6)", "GlcNAc(b1-6)[Man(a1-6)", "GlcNAc(b1-6)[GlcNAc(b1-2)]Man(a1-6)")
O_LINKED = ("Gal(b1-3)GalNAc", "GlcNAc(b1-6)[Gal(b1-3)]GalNAc", "GlcNAc(b1-3)GalNAc", "GlcNAc(b1-6)[GlcNAc(b1-3)]GalNAc")
GAG = ("GlcA(b1-3)Gal(b1-3)Gal(b1-4)Xyl", "IdoA")
GAG_PAIRS = (("GlcA", "GlcNAc"), ("GlcA", "GalNAc"), ("GlcN", "GlcA"), ("GlcN", "IdoA"))


def _any(col: Column, options: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for x in options:
        out = out | col.contains(x)
    return out


def _count(col: Column, word: str) -> Column:
    return ((F.length(col) - F.length(F.replace(col, F.lit(word), F.lit("")))) / len(word)).cast("int")


def keywords(name: Column, end_anchor: bool = True) -> Column:
    """The sorted keywords of a condensed name; none for an empty or null one.

    end_anchor: a name that ends in GalNAc is O-linked; off, as some annotations have it, it is not.
    """
    n = F.coalesce(name, F.lit(""))
    n_linked = n.endswith(CORE) | n.endswith(FUCOSYLATED_CORE)
    mannose, has_core = _count(n, "Man"), _any(n, CORES)
    # the core's own fucose is allowed
    bare = F.when(n.endswith(FUCOSYLATED_CORE), F.replace(n, F.lit("[Fuc(a1-6)]GlcNAc"), F.lit("GlcNAc"))).otherwise(n)
    oligo = (mannose >= 3) & ~_any(n, NOT_OLIGOMANNOSE) & ~bare.contains("Fuc(") & ~(n.contains("GlcNAc(b1-4)Man") & ~n.contains(CORE))
    arm3, arm6 = _any(n, ARM_3), _any(n, ARM_6)
    complex_ = has_core & n.contains("GlcNAc(b1-2)Man") & arm3 & arm6
    hybrid = has_core & (mannose > 3) & (arm3 != arm6)
    on3, on6 = arm3.cast("int") + _any(n, ARM_3_MORE).cast("int"), arm6.cast("int") + _any(n, ARM_6_MORE).cast("int")
    antennae = F.when((on3 > 0) & (on6 > 0), on3 + on6)
    is_complex = n_linked & ~oligo & complex_
    o_linked = _any(n, O_LINKED) | (n.endswith("GalNAc") if end_anchor else F.lit(False))
    gag = _any(n, GAG)
    for a, b in GAG_PAIRS:
        gag = gag | (n.contains(a) & n.contains(b))
    tags = [
        (n_linked, "N-Glycan"),
        (n_linked & n.contains(FUCOSYLATED_CORE), "Fucosylated N-Glycan"),
        (n_linked & oligo, "Oligomannose"),
        (is_complex, "Complex N-Glycan"),
        (is_complex & (antennae == 2), "Biantennary N-Glycan"),
        (is_complex & (antennae == 3), "Triantennary N-Glycan"),
        (is_complex & (antennae >= 4), "Tetraantennary N-Glycan"),
        (n_linked & ~oligo & ~complex_ & hybrid, "Hybrid N-Glycan"),
        (o_linked, "O-Glycan"),
        (gag, "GAG"),
    ]
    return F.array_sort(F.filter(F.array(*(F.when(c & (n != ""), F.lit(t)) for c, t in tags)), lambda x: x.isNotNull()))
