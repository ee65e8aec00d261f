"""Ground truth of planets: masses from orbits, and which of the reported masses fits them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X

#: Fixed values in SI units: gravitation, masses of Sun and Earth, a day; the open band of agreeing masses.
GRAVITY, SUN, EARTH, DAY = 6.674e-11, 1.989e30, 5.972e24, 86400.0
LOW, HIGH = 1 / 3, 3.0


def msini_earth(k: Column, period: Column, e: Column, star: Column) -> Column:
    """Minimum mass in Earth masses from the orbit; null where a value is missing or not positive."""
    third = F.lit(1.0 / 3.0)
    round_ = F.sqrt(F.lit(1.0) - F.pow(F.when((e >= 0) & (e < 1), e).otherwise(0.0), F.lit(2.0)))
    mass = k * F.pow(star * F.lit(SUN), F.lit(2.0 / 3.0)) * F.pow(period * F.lit(DAY) / F.lit(2 * math.pi * GRAVITY), third) * round_
    return F.when((k > 0) & (period > 0) & (star > 0), mass / F.lit(EARTH))


def outside_band(a: Column, b: Column) -> Column:
    return ~((a / b > LOW) & (a / b < HIGH))


def mass_choice(msini: Column, best: Column, check: Column) -> Column:
    """mass, source and flag: the reported mass nearest to the check by ratio, the minimum mass on a tie.

    Without a check the minimum mass goes first; two masses that disagree are then flagged. Zeros are no values.
    """
    usable = lambda v: F.nullif(v, F.lit(0.0))
    near = lambda v, rank, name: F.when(usable(v).isNotNull(), F.struct(F.abs(F.log(usable(v) / check)).alias("d"), F.lit(rank).alias("r"), F.lit(name).alias("source"), v.alias("mass")))
    picked = F.array_min(F.filter(F.array(near(msini, 0, "msini"), near(best, 1, "bmass")), lambda c: c.isNotNull()))
    checked = check.isNotNull() & (check != 0) & (usable(msini).isNotNull() | usable(best).isNotNull())
    source = F.when(checked, picked["source"]).when(msini.isNotNull(), "msini").when(best.isNotNull(), "bmass")
    mass = F.when(checked, picked["mass"]).otherwise(F.when(msini.isNotNull(), usable(msini)).otherwise(usable(best)))
    flag = F.when(checked & outside_band(mass, check), "no reported mass fits the orbit").when(~checked & usable(msini).isNotNull() & usable(best).isNotNull() & outside_band(msini, best), "reported masses disagree and no orbit decides")
    return F.struct(mass.alias("mass"), source.alias("source"), flag.alias("flag"))


def ground_truth(table: DataFrame) -> DataFrame:
    """Planets of an archive table (slug, pl_name, pl_rvamp, pl_orbper, ...), by period, those without one last."""
    value = lambda c: X.number(F.col(c))
    out = table.select(
        "slug", F.element_at(F.split("pl_name", " "), -1).alias("letter"), value("pl_orbper").alias("P_days"), value("pl_rvamp").alias("K_ms"), value("pl_orbeccen").alias("e"),
        value("pl_msinie").alias("msini"), value("pl_bmasse").alias("bmass"), X.unmasked(F.col("pl_bmassprov")).alias("bmass_prov"), value("st_mass").alias("star"),
        X.unmasked(F.col("discoverymethod")).alias("method"), value("disc_year").cast("int").alias("disc_year"), X.unmasked(F.col("disc_refname")).alias("disc_refname"),
    )
    out = out.withColumn("check", msini_earth(F.col("K_ms"), F.col("P_days"), F.col("e"), F.col("star")))
    out = out.withColumn("choice", mass_choice(F.col("msini"), F.col("bmass"), F.col("check")))
    cols = ["slug", "letter", "P_days", "K_ms", "e", "msini", "bmass", "bmass_prov", F.col("choice.mass").alias("mass"), F.col("choice.source").alias("mass_source"), F.round("check", 3).alias("msini_check"), F.col("choice.flag").alias("mass_flag"), "method", "disc_year", "disc_refname", F.lit("confirmed").alias("status")]
    return out.select(*cols).orderBy("slug", F.col("P_days").asc_nulls_last(), "letter")


def hosts(table: DataFrame, second: DataFrame) -> DataFrame:
    """One row a slug (its first), with the spectral type of a second catalogue only where the first has none."""
    value = lambda c: X.number(F.col(c))
    one = table.groupBy("slug").agg(F.min_by(F.struct("st_spectype", "st_teff", "st_mass", "st_rotp", "sy_dist", "sy_vmag", "ra", "dec"), "ordinal").alias("h")).select("slug", "h.*")
    both = one.join(second.select("slug", F.col("spectral_type").alias("other")), "slug", "left")
    names = {"st_teff": "teff_K", "st_mass": "mass_msun", "st_rotp": "st_rotp_days", "sy_dist": "dist_pc", "sy_vmag": "Vmag", "ra": "ra_deg", "dec": "dec_deg"}
    return both.select("slug", F.coalesce(X.unmasked(F.col("st_spectype")), X.unmasked(F.col("other"))).alias("spectral_type"), *[value(c).alias(n) for c, n in names.items()])
