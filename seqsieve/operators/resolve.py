"""From sample sheets and genome details to the expected and the control genomes of each sample.

All tables here are metadata. Orders that matter in lists come from an explicit place: the row of the sheet and the
place in its list."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import null_if_missing, split_tokens, trim_white
from ..sources.store import written
from . import checks


def cleaned(df: DataFrame) -> DataFrame:
    """A metadata table whose empty and NA values are null."""
    return df.select(*(null_if_missing(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes))


def in_order(df: DataFrame, column: str = "ordinal") -> DataFrame:
    """Numbers the rows of a metadata table from 1 in their order. The table is small and its order is the file's, so one
    task numbers it."""
    placed = df.coalesce(1).withColumn("__place", F.monotonically_increasing_id())
    return placed.withColumn(column, F.row_number().over(Window.orderBy("__place"))).drop("__place")


def add_ids(sheet: DataFrame) -> DataFrame:
    """Numbers the rows of a checked sheet in their order: id, and the user's id as user_id."""
    sheet = checks.require_columns(cleaned(sheet), ["id", "fastq", "species", "controls"], "sample sheet")
    checks.require_unique(checks.require_value(checks.require_rows(sheet, "sample sheet"), "id", "sample sheet"), "id", "sample sheet")
    return in_order(sheet, "n").select(F.col("n").alias("id"), F.col("id").alias("user_id"), "fastq", "species", "controls")


def with_index(details: DataFrame, indexes: DataFrame) -> DataFrame:
    """Genome details joined with indexes (column id) by name whatever the case: genome, species, synonyms, has_index.
    Rows of one side stay, and the index's spelling wins. If details have an ordinal, so has the result: theirs, and
    after them indexes without details by name."""
    ordered = [F.col("ordinal")] if "ordinal" in details.columns else []
    left = details.select("genome", "species", "synonyms", F.lower("genome").alias("lower"), *ordered)
    right = indexes.select("id", F.lower("id").alias("lower"))
    joined = left.join(right, "lower", "full_outer")
    name = F.coalesce("id", "genome")
    if ordered:
        ordered = [F.row_number().over(Window.orderBy(F.asc_nulls_last("ordinal"), name)).alias("ordinal")]
    return joined.select(name.alias("genome"), "species", "synonyms", F.col("id").isNotNull().alias("has_index"), *ordered)


def synonym_table(genomes: DataFrame) -> DataFrame:
    """Distinct (genome, synonym): a genome's name, its species and its listed synonyms, trimmed and in lower case."""
    names = genomes.select("genome", F.col("genome").alias("synonym"))
    species = genomes.select("genome", F.col("species").alias("synonym"))
    listed = genomes.select("genome", F.explode(split_tokens(F.col("synonyms"))).alias("synonym"))
    all_names = names.unionByName(species).unionByName(listed).withColumn("synonym", trim_white(F.col("synonym")))
    return all_names.filter(F.length("synonym") > 0).select("genome", F.lower("synonym").alias("synonym")).distinct()


def tokens(samples: DataFrame, column: str) -> DataFrame:
    """A row for each item of a list column: id, place, token as written, and its synonym form."""
    rows = samples.select("id", F.posexplode(split_tokens(F.col(column))).alias("place", "token")).dropna()
    return rows.withColumn("synonym", F.lower(trim_white(F.col("token"))))


def matches(samples: DataFrame, column: str, genomes: DataFrame, synonyms: DataFrame) -> DataFrame:
    """tokens() with the genome, species and has_index that they stand for; no match: nulls."""
    known = synonyms.join(genomes.select("genome", "species", "has_index"), "genome")
    return tokens(samples, column).join(known, "synonym", "left")


def first_places(found: DataFrame) -> DataFrame:
    """Distinct (id, genome) with the first place in the list. Two names of one genome count once."""
    return found.filter(F.col("genome").isNotNull()).groupBy("id", "genome").agg(F.min("place").alias("place"))


def without(genomes: DataFrame, controls: DataFrame) -> DataFrame:
    """Expected genomes that are no control of the same sample."""
    return genomes.join(controls.select("id", "genome"), ["id", "genome"], "left_anti")


def collapsed(genomes: DataFrame, name: str) -> DataFrame:
    """id and the genomes in order, joined by bars."""
    listed = F.array_sort(F.collect_list(F.struct("place", "genome")))
    return genomes.groupBy("id").agg(F.array_join(F.transform(listed, lambda x: x["genome"]), "|").alias(name))


@dataclass
class Resolved:
    """Checked tables, and what a user should be warned of."""

    samples: DataFrame
    genomes: DataFrame
    expected: DataFrame
    controls: DataFrame
    warnings: list[str] = field(default_factory=list)


def _warnings(found: DataFrame, what: str) -> list[str]:
    unknown = [r[0] for r in found.filter(F.col("genome").isNull()).select("token").distinct().orderBy("token").collect()]
    bare = [r[0] for r in found.filter(~F.col("has_index")).select("species").distinct().orderBy("species").collect()]
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    out = [f"no genome is known for these {what}: {quoted(unknown)}"] if unknown else []
    return out + ([f"no index was found for these {what}: {quoted(bare)}"] if bare else [])


def resolve(samples: DataFrame, details: DataFrame, indexes: DataFrame) -> Resolved:
    """Checks the metadata and finds each sample's genomes. samples: id, user_id, species, controls. An ordinal of samples
    or of details is kept, in the checked samples and genomes."""
    kept = lambda df: ["ordinal"] if "ordinal" in df.columns else []
    samples = written(checks.require_columns(cleaned(samples), ["id", "user_id", "species", "controls", *kept(samples)], "samples"), "samples")
    checks.require_unique(checks.require_value(checks.require_rows(samples, "samples"), "id", "samples"), "id", "samples")
    checks.require_case_unique(checks.require_no_bar(indexes, "id", "indexes"), "id", "indexes")
    details = written(checks.require_columns(cleaned(details), ["genome", "species", "synonyms", *kept(details)], "genome details"), "details")
    checks.require_unique(checks.require_no_bar(details, "genome", "genome details"), "genome", "genome details")
    checks.require_case_unique(checks.require_value(details, "genome", "genome details"), "genome", "genome details")

    genomes = written(with_index(details, indexes), "genomes")
    synonyms = written(synonym_table(genomes), "synonyms")
    several = [r[0] for r in checks.ambiguous_synonyms(synonyms).orderBy("synonym").limit(20).collect()]
    if several:
        raise checks.ScreenError("synonyms of more than one genome: " + ", ".join(f"'{x}'" for x in several))

    species, controls = (written(matches(samples, c, genomes, synonyms), "matches") for c in ("species", "controls"))
    control = first_places(controls)
    expected = without(first_places(species), control)
    out = samples.join(collapsed(expected, "genomes"), "id", "left").join(collapsed(control, "control_genomes"), "id", "left")
    return Resolved(out, genomes.filter("has_index").select("genome", "species", *kept(genomes)), expected, control, _warnings(species, "species") + _warnings(controls, "controls"))
