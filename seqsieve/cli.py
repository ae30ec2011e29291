"""python -m seqsieve.cli: a screen of files."""

from __future__ import annotations

import argparse

from .config import ScreenConfig


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="seqsieve", description="Screens sequencing reads for the genomes that they come from.")
    own = out.add_argument_group("a screen of reads")
    own.add_argument("--sample-sheet", help="CSV with columns id, fastq, species, controls")
    own.add_argument("--genome-details", help="CSV with columns genome, species, synonyms")
    own.add_argument("--references", nargs="+", help="a FASTA file for each genome, named GENOME.fa")
    own.add_argument("--genome-dir", help="folder of stored genomes, in place of --references")
    own.add_argument("--adapters", help="FASTA file of adapters")
    own.add_argument("--store-genomes", nargs="+", help="FASTA files (GENOME.fa) to store in --genome-dir, for later screens")
    ready = out.add_argument_group("summaries of alignments that other tools made")
    ready.add_argument("--checked-samples", help="CSV with columns id, user_id, species, controls, genomes, control_genomes")
    ready.add_argument("--checked-genomes", help="CSV with columns genome, species")
    ready.add_argument("--sampling-summary", help="CSV with columns id, read, sampled")
    ready.add_argument("--genome-alignments", help="tab-separated genome alignments")
    ready.add_argument("--adapter-alignments", help="tab-separated adapter alignments")
    written = out.add_argument_group("a chart of written summaries")
    written.add_argument("--summary", help="the sample summary that a run wrote")
    written.add_argument("--alignment-summary", help="the alignment summary that a run wrote")
    defaults = ScreenConfig()
    for name in ("sample_size", "max_reads", "chunk_size", "trim_start", "trim_length", "max_mismatches"):
        out.add_argument("--" + name.replace("_", "-"), type=int, default=getattr(defaults, name), help="default: %(default)s")
    for name in ("seed", "fastq_dir", "output_dir", "output_prefix"):
        out.add_argument("--" + name.replace("_", "-"), default=getattr(defaults, name), help="default: %(default)r")
    return out


OWN = ("sample_sheet", "genome_details", "references", "adapters")
STORED = ("genome_dir", "store_genomes")
READY = ("checked_samples", "checked_genomes", "sampling_summary", "genome_alignments", "adapter_alignments")
WRITTEN = ("summary", "alignment_summary")


def store(files: list[str], folder: str) -> None:
    """Stores each file's genome, leaving those that are there."""
    from pyspark.sql import SparkSession

    from .sources import genomes

    spark = SparkSession.builder.appName("seqsieve").getOrCreate()
    for name in genomes.genome_names(files):
        genomes.store_genome(spark, name, [f for f in files if genomes.genome_name(f) == name], folder)
        print(f"stored: {name}")


def main(args: list[str] | None = None) -> None:
    reader = parser()
    given = vars(reader.parse_args(args))
    genome_dir, to_store = (given.pop(k) for k in STORED)
    own, ready, written = kinds = [[given.pop(k) for k in names] for names in (OWN, READY, WRITTEN)]
    if to_store:
        if not genome_dir or any(map(any, kinds)):
            reader.error("--store-genomes wants --genome-dir and nothing else")
        store(to_store, genome_dir)
        return
    if genome_dir and own[2] is None:
        own[2] = []  # the folder stands in their place
    whole = [all(x or (x == [] and genome_dir) for x in kind) for kind in kinds]
    if sum(map(any, kinds)) != 1 or not any(whole) or (genome_dir and not whole[0]):
        reader.error("give all files of a screen of reads, all files of ready alignments, or both written summaries")
    config = ScreenConfig(**given)
    from pyspark.sql import SparkSession

    from .plans.screen import plot_of_files, run_files, summarise_files, write_charts

    spark = SparkSession.builder.appName("seqsieve").getOrCreate()
    print("\n".join(f"{k}: {v}" for k, v in given.items()))
    if all(written):
        write_charts(plot_of_files(spark, *written), config)
        return
    result = run_files(spark, *own, config, genome_dir) if whole[0] else summarise_files(spark, *ready)
    for warning in result.warnings:
        print(f"Warning: {warning}")
    result.write(config)
    write_charts(result.plot_data(), config)


if __name__ == "__main__":
    main()
