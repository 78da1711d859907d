"""Parameters of the jobs, with the values that a standard run uses."""

from __future__ import annotations

from dataclasses import dataclass, fields

# The defaults below (constants, adapter, tiers, weights, cutoffs) and the classes' names are fixed values of the method.
QUALITY_CLASSES = ("HQ_HI", "HQ_LO", "LQ_HI", "LQ_LO")


class Checked:
    """Refuses negative numbers and flags that are not True or False."""

    def __post_init__(self):
        for f in fields(self):
            value = getattr(self, f.name)
            if f.type == "bool" and not isinstance(value, bool):
                raise ValueError(f"{f.name} must be True or False, not {value!r}")
            if f.type in ("int", "float") and not value >= 0:
                raise ValueError(f"{f.name} must not be negative, but is {value!r}")


@dataclass(frozen=True)
class DemuxParams(Checked):
    constant1: str = "GTACGTACGAGTC"
    constant2: str = "GTACTCGCAGTAGTC"
    adapter: str = "TGTCTCTTATACACATCTCCGAGCCCACGAG"
    half_length: int = 9
    min_read_length: int = 20
    barcode_mismatches: bool = True


@dataclass(frozen=True)
class AssignParams(Checked):
    primer_length: int = 18
    off_by_one: bool = True
    window: int = 3
    min_reads_per_cell: int = 10


@dataclass(frozen=True)
class CallParams(Checked):
    ploidy: int = 2
    noise: float = 0.01
    ignore_substitutions: bool = False
    report_depth: int = 5


@dataclass(frozen=True)
class QualityParams(Checked):
    tiers: tuple[float, ...] = (0.975, 0.99, 0.999, 0.9999)
    weights: tuple[int, ...] = (1, 10, 50, 100)
    depth_cutoff: int = 10_000
    min_reads_per_amplicon: int = 0
    min_total_reads: int = 0
    selected: tuple[str, ...] = ("HQ_HI",)


@dataclass(frozen=True)
class ZygosityParams(Checked):
    low_pct: float = 20.0
    high_pct: float = 80.0
    second_allele_pct: float = 20.0
    mark_no_data: bool = False
