"""The switches that tell textbook behaviour from that of the original experiments.

Every switch belongs to one documented quirk; `STANDARD` turns all off,
`REFERENCE` turns all on.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Compat:
    copies: int = 1                 # how often each document counts
    quantize: bool = False          # document lengths on the 4-significant-bit grid
    fuse_lines: bool = False        # topic lines joined without a separator
    hits_over_cut: bool = False     # "average precision" = relevant hits / cut
    drop_without_hits: bool = False  # topics without a relevant hit leave the report
    mean_divisor: int = 1           # report means are divided by this times the topics
    grid_divisor: int | None = None  # grid means are divided by this, not by the topics
    best_single_cell: bool = False  # best lambda = first highest (topic, lambda) cell
    dedupe_judgments: bool = True   # a judgment listed twice counts once
    lenient_names: bool = False     # an unknown model means tfidf


STANDARD = Compat()
REFERENCE = Compat(copies=2, quantize=True, fuse_lines=True, hits_over_cut=True,
                   drop_without_hits=True, mean_divisor=3, grid_divisor=11,
                   best_single_cell=True, dedupe_judgments=False, lenient_names=True)
