"""Parameters of a screen, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass


def _at_least(name: str, value: int, least: int) -> None:
    if value < least:
        raise ValueError(f"{name} must be at least {least}, not {value}")


@dataclass(frozen=True)
class ScreenConfig:
    """Parameters of a whole run, with the limits that a run has."""

    sample_size: int = 100_000
    max_reads: int = 100_000_000
    chunk_size: int = 1_000_000
    trim_start: int = 1
    trim_length: int = 36
    max_mismatches: int = 2
    seed: str = "1"
    fastq_dir: str = ""
    output_dir: str = "."
    output_prefix: str = ""

    def __post_init__(self) -> None:
        _at_least("sample_size", self.sample_size, 1000)
        _at_least("max_reads", self.max_reads, self.sample_size)
        _at_least("chunk_size", self.chunk_size, 100_000)
        _at_least("trim_start", self.trim_start, 1)
        _at_least("trim_length", self.trim_length, 30)
        _at_least("max_mismatches", self.max_mismatches, 0)

    @property
    def min_length(self) -> int:
        """Reads must reach the end of the trimmed part."""
        return self.trim_start + self.trim_length - 1

    def input_path(self, path: str) -> str:
        """A path of the sample sheet below fastq_dir, with one slash between them."""
        return f"{self.fastq_dir.rstrip('/')}/{path}" if self.fastq_dir else path

    def output_path(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{self.output_prefix}{name}"


def check_tool_limits(files: list[str], **numbers: int) -> None:
    """The looser limits of the single steps: every number is positive and there is a file."""
    if not files:
        raise ValueError("at least one file is needed")
    for name, value in numbers.items():
        _at_least(name, value, 1)
