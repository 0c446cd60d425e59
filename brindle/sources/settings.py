"""Settings: barcode layouts and tags, formats, chromosome maps, samples; parsed on the driver and checked."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

# The categories of barcode tags and the normalisations of coverage.
CATEGORIES = ("EVEN", "ODD", "Y", "RPM", "DPM", "LIGTAG", "SPACER")
NORMALIZATIONS = ("None", "CPM", "RPKM", "BPM", "RPGC")
# How files of reads end, and how gzip files begin.
READ_FILES = (".fastq.gz", ".fq.gz", ".bam")
GZIP = b"\x1f\x8b"


@dataclass
class BarcodeConfig:
    layout: dict[str, list[str]] = field(default_factory=dict)
    tags: list[tuple[str, str, str, int]] = field(default_factory=list)
    spacer: int = 6
    laxity: int = 6

    def n_tags(self) -> int:
        return sum(c != "SPACER" for part in self.layout.values() for c in part)

    def targets(self) -> list[str]:
        """Oligo names without their prefix, in order, once each."""
        return list(dict.fromkeys(name[5:] for _, name, _, _ in self.tags if name.startswith("BEAD_")))


def well_named(category: str, name: str) -> bool:
    """DPM tags are chromatin, with DPM in their name, or oligos that begin with BEAD_; no other tag has DPM or BEAD in its name."""
    if category == "DPM":
        return name.startswith("BEAD_") or "DPM" in name and "BEAD" not in name
    return "DPM" not in name and "BEAD" not in name


def parse_barcodes(text: str) -> BarcodeConfig:
    """`READ1 = A|B`, `READ2 = ...`, `SPACER = n`, `LAXITY = n` and rows of category, name, sequence, mismatches; # comments."""
    out = BarcodeConfig()
    for number, line in enumerate(text.splitlines(), 1):
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        key, equal, value = line.partition(" = ")
        if equal and key in ("READ1", "READ2"):
            out.layout[key] = [c.strip().upper() for c in value.split("|")]
            if unknown := [c for c in out.layout[key] if c != "SPACER" and c not in CATEGORIES]:
                raise ValueError(f"line {number}: {unknown[0]!r} in {key} is no category of tags")
        elif equal and key in ("SPACER", "LAXITY"):
            setattr(out, key.lower(), int(value))
        else:
            cells = line.split("\t")
            if len(cells) != 4 or cells[0] not in CATEGORIES or not cells[3].strip().isdigit():
                raise ValueError(f"line {number}: not a tag: {line!r}")
            if not re.match(r"[a-zA-Z0-9_\-]+$", cells[1]):
                raise ValueError(f"line {number}: tag name {cells[1]!r}")
            if not well_named(cells[0], cells[1]):
                raise ValueError(f"line {number}: {cells[1]!r} is no name of a {cells[0]} tag")
            out.tags.append((cells[0], cells[1], cells[2].strip().upper(), int(cells[3])))
    if not out.layout:
        raise ValueError("no layout")
    return out


def parse_split_table(text: str) -> dict[str, list[str]]:
    """Targets and their sequences in a TSV whose header names tags and ids (either in the singular)."""
    rows = [line.split("\t") for line in text.splitlines() if line.strip() and not line.startswith(("#", "@"))]
    head = [h.lower().rstrip("s") for h in rows[0]]
    tag, name = head.index("tag"), head.index("id")
    out: dict[str, list[str]] = {}
    for row in rows[1:]:
        if row[name].startswith("BEAD_"):
            out.setdefault(row[name][5:], []).append(row[tag])
    return out


def parse_format(text: str) -> dict[str, list[int]]:
    """Tag name to its sorted rounds, of rows (round, tag)."""
    out: dict[str, set[int]] = {}
    for line in text.splitlines():
        if line.strip():
            number, tag = line.split("\t")[:2]
            out.setdefault(tag.strip(), set()).add(int(number))
    return {tag: sorted(rounds) for tag, rounds in out.items()}


def parse_chrom_map(text: str) -> list[tuple[str, str]]:
    """(old, new) in file order, one to one; a line that begins with a double quote is a comment."""
    rows = [tuple(line.split("\t")) for line in text.splitlines() if line.strip() and not line.startswith('"')]
    if any(len(r) != 2 for r in rows):
        raise ValueError("a chromosome map has two columns")
    for column in zip(*rows):
        if len(set(column)) != len(column):
            raise ValueError("a chromosome map is one to one")
    return rows


def load_config(path: str) -> dict:
    """A configuration in JSON, or in YAML where that library is there (it reads JSON too)."""
    with open(path, encoding="utf-8") as file:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as missing:
                raise ValueError(f"{path}: no library for YAML here, give JSON") from missing
            return yaml.safe_load(file) or {}
        return json.load(file)


def write_config(config: dict, path: str) -> None:
    """A snapshot of a configuration as JSON, for a run's records."""
    with open(path, "w", encoding="utf-8") as file:
        json.dump(config, file, indent=4, sort_keys=True)


def long_names(samples: Iterable[str], targets: Iterable[str], split: bool = True) -> list[str]:
    """What is wrong with names: targets of letters, digits, _ and -, samples of SAMPLE_CHARS at most, and with files by target, sample and target together of PAIR_CHARS."""
    samples, targets = list(samples), list(targets)
    out = [f"target {t!r} has other characters than letters, digits, _ and -" for t in targets if not re.fullmatch(r"[a-zA-Z0-9_\-]+", t)]
    out += [f"sample {s!r} has more than {SAMPLE_CHARS} characters" for s in samples if len(s) > SAMPLE_CHARS]
    longest = (max(samples, key=len, default=""), max(targets, key=len, default=""))
    if split and sum(map(len, longest)) > PAIR_CHARS:
        out.append(f"sample {longest[0]!r} and target {longest[1]!r} have together more than {PAIR_CHARS} characters")
    return out


def without(wildcards: dict[str, list[str]], exclude: dict[str, list[str]]) -> dict[str, list[str]]:
    """Each field's values but those that are excluded for it."""
    return {field: [v for v in values if v not in set(exclude.get(field, ()))] for field, values in wildcards.items()}


def parse_samples(text: str) -> dict[str, dict[str, list[str]]]:
    """Sample to the paths of R1 and R2."""
    out = json.loads(text)
    for sample, sides in out.items():
        if "." in sample or not {"R1", "R2"} <= sides.keys():
            raise ValueError(f"sample {sample!r}")
    return out


def not_gzip(samples: dict[str, dict[str, list[str]]]) -> list[str]:
    """The paths of samples whose files do not begin as gzip does."""
    out = []
    for sides in samples.values():
        for path in sides["R1"] + sides["R2"]:
            with open(path, "rb") as file:
                if file.read(len(GZIP)) != GZIP:
                    out.append(path)
    return out


def level_faults(levels: dict[str, dict]) -> list[str]:
    """What is wrong with levels of a pipeline (path as a list of parts, parent, base): each has a path, but for data, that ends as a file of reads does, and names levels."""
    out = []
    for level, facts in levels.items():
        path = facts.get("path")
        if level != "data" and "path" not in facts:
            out.append(f"{level} has no path")
        if path and not path[-1].endswith(READ_FILES):
            out.append(f"{level} has a path of no known kind: {path[-1]}")
        out += [f"{level} has the unknown {role} {facts[role]}" for role in ("parent", "base") if facts.get(role) is not None and facts[role] not in levels]
    return out


def missing_keys(config: dict, required: tuple[str, ...]) -> list[str]:
    """The required keys that a configuration lacks, in order."""
    return [key for key in required if key not in config]


def discover_samples(folder: str) -> dict[str, dict[str, list[str]]]:
    """FASTQ files below a folder, by the sample that their names begin with."""
    out: dict[str, dict[str, list[str]]] = {}
    for top, _, names in os.walk(folder):
        for name in sorted(names):
            # Fixed value: how the files of a sample are named.
            if found := re.fullmatch(r"(.+)_(R[12]).(fastq.gz|fq.gz|fastq|fq)", name):
                out.setdefault(found[1], {}).setdefault(found[2], []).append(os.path.join(top, name))
    return out


#: The longest names from which all files' names can be made.
SAMPLE_CHARS, PAIR_CHARS = 214, 227


@dataclass
class Settings:
    """Parameters of the read pipeline, with the ranges they must lie in."""

    min_oligos: int = 2
    proportion: float = 0.8
    max_size: int = 10_000
    num_chunks: int = 2
    bin_size: int = 100
    normalization: str = "None"
    umi_length: int = 8

    def __post_init__(self) -> None:
        if not 1 <= self.num_chunks <= 99 or self.normalization not in NORMALIZATIONS or self.bin_size < 1 or not 0 <= self.proportion <= 1 or self.min_oligos < 1:
            raise ValueError(f"out of range: {self}")
