"""A whole screen as one plan: from samples, reads, genomes and alignments to the summaries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ScreenConfig, check_tool_limits
from ..functions import split_tokens
from ..operators import align, assign, checks, resolve, sampling, summarize
from ..operators.chart import bar_chart, bar_chart_pdf, plot_data
from ..sources import fastq, genomes, tables
from ..sources.store import Store, written

TIES = ["genome_ordinal", "chromosome", "position", "strand"]


@dataclass
class ScreenResult:
    summary: DataFrame
    alignment_summary: DataFrame
    genome_alignments: DataFrame
    adapter_alignments: DataFrame
    warnings: list[str] = field(default_factory=list)
    #: what the tables above share and Spark keeps until release(); lost parts are computed anew
    kept: list[DataFrame] = field(default_factory=list)
    #: the sampling summary and the checked metadata, where this run made them
    sampled: DataFrame | None = None
    resolved: resolve.Resolved | None = None

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()

    def plot_data(self) -> DataFrame:
        """Chart data; the summary's rows are in order, which the single task that numbers them keeps."""
        placed = self.alignment_summary.coalesce(1).withColumn("place", F.monotonically_increasing_id())
        return plot_data(placed, self.summary)

    def write(self, config: ScreenConfig) -> None:
        """The tables of the result, and what a run has checked and sampled."""
        tables.write_table(self.summary, config.output_path("summary.csv"))
        tables.write_table(self.alignment_summary, config.output_path("alignment_summary.csv"))
        write_alignments(self.genome_alignments, config.output_path("genome_alignments.tsv"))
        write_alignments(self.adapter_alignments, config.output_path("adapter_alignments.tsv"))
        if self.sampled is not None:
            tables.write_table(self.sampled.select("id", "read", "sampled"), config.output_path("sampling_summary.csv"))
        if self.resolved is not None:
            write_checked(self.resolved, config)


def write_alignments(df: DataFrame, path: str) -> None:
    """Alignments as zipped, tab-separated files in the order of the rows."""
    tables.write_table(df, path, "\t", True, False)


def ordinals(df: DataFrame, column: str) -> DataFrame:
    """Adds ordinal in the order of a column of a dimension table."""
    return df.withColumn("ordinal", F.row_number().over(Window.orderBy(column)))


def with_ordinal(samples: DataFrame) -> DataFrame:
    """Numbered samples whose number is text from here on, as ids of alignments are, and keeps their order as ordinal."""
    return samples.withColumn("ordinal", F.col("id")).withColumn("id", F.col("id").cast("string"))


def bridges(samples: DataFrame, genomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (id, genome) of expected and of control genomes, from checked samples. Names without an index are text
    of a sample but no genome of the screen."""
    known = genomes.select("genome")

    def of(column: str) -> DataFrame:
        rows = samples.select("id", F.explode(split_tokens(F.col(column), spaced=True)).alias("genome"))
        return rows.join(known, "genome").select("id", "genome").distinct()

    return of("genomes"), of("control_genomes")


def summarise(samples: DataFrame, genomes: DataFrame, sampled: DataFrame, alignments: DataFrame, adapters: DataFrame, warnings: list[str] | None = None) -> ScreenResult:
    """The relational core. samples: id, user_id, species, controls, genomes, control_genomes; genomes: genome,
    species; sampled: id, read, sampled; alignments: id, read, genome, chromosome, position, strand, sequence, quality,
    mismatches (a number), length; adapters: as sources.tables.adapter_alignments."""
    samples = samples.join(sampled.select("id", F.col("read").alias("sequences"), "sampled"), "id")
    samples = written(ordinals(samples, "id") if "ordinal" not in samples.columns else samples, "samples")
    genomes = written(ordinals(genomes, "genome") if "ordinal" not in genomes.columns else genomes, "genomes")
    expected, controls = (written(b, "bridge") for b in bridges(samples, genomes))
    here = alignments.join(samples.select("id"), "id", "left_semi").join(genomes.select("genome", F.col("ordinal").alias("genome_ordinal")), "genome")
    rows = assign.read_level(assign.annotate(here, expected, controls)).persist()
    chosen, sums = assign.chosen_and_sums(rows, TIES, samples.count() * genomes.count())
    sums = written(sums, "sums")  # metadata: a row for each sample and genome

    aligned, assigned = (summarize.genome_part(sums, samples, genomes, kind) for kind in ("aligned", "assigned"))
    unmapped = summarize.unmapped_summary(assigned, samples)
    counts = written(summarize.adapter_counts(adapters, samples), "adapter-counts")
    reads = (summarize.read_part(sums, samples, kind) for kind in ("expected_reads", "control_reads"))
    summary = summarize.sample_summary(samples, *reads, unmapped, counts)
    by_genome = summarize.alignment_summary(samples, genomes, aligned, assigned, unmapped, expected, controls)

    users = samples.select("id", "user_id", "ordinal")
    out = chosen.join(users, "id").orderBy("ordinal", "read", "genome_ordinal")
    out = out.select(F.col("user_id").alias("id"), "read", "genome", "chromosome", "position", "strand", "sequence", "quality", "mismatches", "expected", "control", "assigned")
    named = adapters.join(users.select("id", "user_id"), "id").withColumn("id", F.col("user_id")).drop("user_id")
    return ScreenResult(summary, by_genome, out, named, warnings or [], [rows])


def sample_and_trim(reads: DataFrame, config: ScreenConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sampled reads, their trimmed form, and the sampling summary. Names must be unique in the sample."""
    capped = sampling.capped(reads, config.max_reads)
    sampled, counts = sampling.one_pass_sample(capped, config.sample_size, config.min_length, config.seed)
    sampled = sampled.persist()
    again = [(r["sample"], r["id"]) for r in checks.repeated_reads(sampled).limit(5).collect()]
    if again:
        raise checks.ScreenError("reads of one name in a sample: " + ", ".join(f"{s}|{r}" for s, r in again))
    return sampled, sampling.trim(sampled, config.trim_start, config.trim_length), counts


def run_screen(samples: DataFrame, reads: DataFrame, details: DataFrame, references: DataFrame, adapters: DataFrame, config: ScreenConfig, names: list[str] | None = None) -> ScreenResult:
    """A screen with the native aligners. samples: id, user_id, species, controls; reads: sample, ordinal, id, seq,
    qual; details: genome, species, synonyms; references: see align.as_pieces; adapters: name, seq. Samples and
    genomes stand in the order of a column ordinal of samples and details, else of their ids and names. names: of the
    genomes that references hold, else they are looked for there."""
    if names is None:
        names = [r["genome"] for r in references.select("genome").distinct().orderBy("genome").collect()]  # metadata: some dozens
    resolved = resolve.resolve(samples, details, samples.sparkSession.createDataFrame([(n,) for n in names], "id string"))
    sampled, trimmed, counts = sample_and_trim(reads, config)
    counts = counts.persist()
    short = trimmed.select(F.col("sample").alias("id"), F.col("id").alias("read"), "seq", "qual")
    found = align.align_ungapped(short, references, config.max_mismatches, config.trim_length, describe=True)
    found = found.join(short.select("id", "read", F.col("qual").alias("quality")), ["id", "read"])
    found = found.withColumn("length", F.length("sequence")).persist()
    whole = sampled.select(F.col("sample").alias("id"), F.col("id").alias("read"), "seq")
    matched = align.match_adapters(whole, adapters).persist()
    checked, genomes = resolved.samples.persist(), resolved.genomes.persist()
    result = summarise(checked, genomes, counts, found, matched, resolved.warnings)
    result.kept += [counts, found, matched, sampled, checked, genomes]
    result.sampled, result.resolved = counts, resolved
    return result


def write_checked(resolved: resolve.Resolved, config: ScreenConfig) -> None:
    """The checked samples and the genomes that have an index, in their order."""
    for df, columns, name in ((resolved.samples, tables.CHECKED_SAMPLES, "samples"), (resolved.genomes, ["genome", "species"], "genomes")):
        df = df.orderBy("ordinal") if "ordinal" in df.columns else df
        tables.write_table(df.select(*columns), config.output_path(f"{name}.checked.csv"))


def summarise_files(spark: SparkSession, samples: str, genomes: str, sampled: str, genome_alignments: str, adapter_alignments: str) -> ScreenResult:
    """The relational core on files that other tools made: checked samples and genomes, a sampling summary, and
    alignments. Samples and genomes keep the order of their files."""

    return summarise(
        resolve.in_order(tables.read_metadata(spark, samples, tables.CHECKED_SAMPLES)),
        resolve.in_order(tables.read_metadata(spark, genomes, ["genome", "species"])),
        tables.sampling_summary(spark, sampled),
        tables.genome_alignments(spark, genome_alignments),
        tables.adapter_alignments(spark, adapter_alignments),
    )


def run_files(spark: SparkSession, sheet: str, details: str, references: list[str] | None, adapters: str, config: ScreenConfig, genome_dir: str | None = None) -> ScreenResult:
    """A screen of files: a sample sheet, genome details, adapters, and as references a FASTA file for each genome (named
    GENOME.fa) or a folder of stored genomes."""
    fastq.register(spark)
    samples = resolve.add_ids(tables.read_metadata(spark, sheet, ["id", "fastq", "species", "controls"]))
    listed = samples.orderBy("id").select(F.col("id").cast("string").alias("id"), "fastq").collect()
    if missing := [r["id"] for r in listed if not r["fastq"]]:
        raise checks.ScreenError(f"no FASTQ files for samples {missing}")
    files = [(r["id"], [config.input_path(p.strip()) for p in r["fastq"].split("|")]) for r in listed]
    check_tool_limits([p for _, ps in files for p in ps], sample_size=config.sample_size, max_reads=config.max_reads, chunk_size=config.chunk_size)
    reads = fastq.read_samples(spark, files, config.max_reads)
    if genome_dir is not None:
        names, pieces = genomes.stored_names(genome_dir), genomes.stored_pieces(spark, genome_dir)
    else:
        names, pieces = genomes.genome_names(references), genomes.read_pieces(spark, references)
    known = spark.read.format("fasta").option("paths", adapters).load().select("name", "seq")
    samples = with_ordinal(samples)
    listed_genomes = resolve.in_order(tables.read_metadata(spark, details, ["genome", "species", "synonyms"]))
    return run_screen(samples, reads, listed_genomes, pieces, known, config, names)


def plot_of_files(spark: SparkSession, summary: str, alignment_summary: str) -> DataFrame:
    """Chart data of written summaries, with the order of their rows."""
    return plot_data(tables.alignment_summary(spark, alignment_summary, "place"), tables.summary(spark, summary))


def chart(result: ScreenResult) -> str:
    return bar_chart(result.plot_data())


def write_charts(plot: DataFrame, config: ScreenConfig) -> None:
    """chart.svg and chart.pdf of chart data, which is computed once."""
    plot = plot.persist()
    for name, drawn in (("chart.svg", bar_chart(plot).encode()), ("chart.pdf", bar_chart_pdf(plot))):
        path = config.output_path(name)
        with Store(path).create(path) as out:
            out.write(drawn)
    plot.unpersist()
