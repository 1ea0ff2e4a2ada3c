"""Settings: YAML overlay on defaults, precedence of call arguments, checks of names."""

from __future__ import annotations

import dataclasses
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Marker dictionaries: name -> (detector enum, bits a side, markers) (fixed values).
DICTIONARIES = {"DICT_4X4_50": (0, 4, 50), "DICT_4X4_100": (1, 4, 100), "DICT_4X4_250": (2, 4, 250), "DICT_5X5_50": (4, 5, 50), "DICT_5X5_100": (5, 5, 100), "DICT_6X6_50": (8, 6, 50)}
#: Page sizes in mm (fixed values).
PAGES = {"A3": (297.0, 420.0), "A4": (210.0, 297.0), "LETTER": (215.9, 279.4)}
VIDEO_ENDINGS = ("mp4", "mov", "avi", "mkv", "m4v")
DEVICES = ("auto", "cuda", "cpu")


#: Least scores of a text-prompted detector's boxes and words (fixed values).
BOX_SCORE, TEXT_SCORE = 0.4, 0.3


# The sections and keys of the YAML file and their defaults (fixed values).
@dataclass
class Extraction:
    stride: int = 1


@dataclass
class Filtering:
    min_markers: int = 1
    valid_ids: list[int] | None = None


@dataclass
class Sheet:
    num_markers: int = 20
    side_pixels: int = 236
    margin_pixels: int = 59
    dictionary: str = "DICT_4X4_50"
    dpi: int = 300
    page_format: str = "A4"


@dataclass
class Masks:
    text_prompt: str = "head."
    detector_model: str = "IDEA-Research/grounding-dino-base"
    segmenter_model: str = "facebook/sam2.1-hiera-large"
    device: str = "auto"


@dataclass
class Settings:
    dictionary: str = "DICT_4X4_250"
    frame_extraction: Extraction = field(default_factory=Extraction)
    frame_filtering: Filtering = field(default_factory=Filtering)
    markers: Sheet = field(default_factory=Sheet)
    mask_generation: Masks = field(default_factory=Masks)


def overlay(base: Any, given: Any) -> Any:
    """base with the declared keys of given; unknown keys are ignored, a section that is no mapping leaves the defaults.

    A leaf that is there with a null value overrides the default with None.
    """
    if not isinstance(given, dict):
        return base
    changed = {}
    for f in dataclasses.fields(base):
        if f.name in given:
            old = getattr(base, f.name)
            changed[f.name] = overlay(old, given[f.name]) if dataclasses.is_dataclass(old) else given[f.name]
    return dataclasses.replace(base, **changed)


def load(path: str | None) -> Settings:
    """Settings of a YAML file; a missing or empty file gives the defaults."""
    import os

    import yaml

    if not path or not os.path.exists(path):
        return Settings()
    with open(path) as f:
        return overlay(Settings(), yaml.safe_load(f) or {})


def configure_logging() -> None:
    """Time, level and message on standard error, from INFO on."""
    import logging

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")


def strong_enough(score: Column, text_score: Column) -> Column:
    """A detector's box that counts: above both thresholds."""
    return (score > BOX_SCORE) & (text_score > TEXT_SCORE)


def first_given(*options: Any) -> Any:
    """The first option that is not None: argument, file, default."""
    return next((x for x in options if x is not None), None)


def first_given_column(*options: Column) -> Column:
    return F.coalesce(*options)


def first_filled_column(given: Column, other: Column) -> Column:
    """Where the mask settings are concerned, an empty string falls through as well."""
    return F.coalesce(F.nullif(given, F.lit("")), other)


def dictionary_code(name: str) -> int:
    if name not in DICTIONARIES:
        raise ValueError(f"unknown dictionary {name!r}; known: {', '.join(sorted(DICTIONARIES))}")
    return DICTIONARIES[name][0]


def page_size(name: str) -> tuple[float, float]:
    if name not in PAGES:
        raise ValueError(f"unknown page format {name!r}; known: {', '.join(sorted(PAGES))}")
    return PAGES[name]


def device(name: str, gpu: bool | None = None) -> str:
    """auto becomes cuda where the session offers a GPU, else cpu; cuda without one is an error."""
    if name not in DEVICES:
        raise ValueError(f"unknown device {name!r}")
    if name == "cuda" and gpu is False:
        raise RuntimeError("cuda was asked for and no GPU is offered")
    return name if name != "auto" else ("cuda" if gpu else "cpu")


def tracker_profile(spark: SparkSession, device: str = "cpu", cpus: int = 1, gpus: float = 1.0, memory: str | None = None) -> ResourceProfile | None:
    """What a task of a tracker's stage asks for: cores, and on cuda a share of a GPU; other stages ask for what they did.

    Where executors come and go, they are asked for with as much (and with memory); elsewhere a task takes more of the
    executors that are there, so fewer run at a time.  None in local mode, which has no profiles.
    """
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return None
    task = TaskResourceRequests().cpus(cpus)
    builder = ResourceProfileBuilder()
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        executor = ExecutorResourceRequests().cores(max(cpus, int(spark.conf.get("spark.executor.cores", "1"))))
        builder = builder.require(executor.memory(memory) if memory else executor)
        if device == "cuda":
            executor.resource("gpu", max(1, round(gpus)))
    return builder.require(task.resource("gpu", gpus) if device == "cuda" else task).build


def check_video(path: str) -> None:
    ending = path.rsplit(".", 1)[-1].lower() if "." in path else ""
    if ending not in VIDEO_ENDINGS:
        raise ValueError(f"{path}: not a video by its ending; known: {', '.join(VIDEO_ENDINGS)}")


def is_video(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*VIDEO_ENDINGS)


def session_name(path: str, stamp: str) -> str:
    return f"{re.sub(r'[.][^./]*$', '', path.rsplit('/', 1)[-1])}_{stamp}"


def session_of(path: Column) -> Column:
    """The folder that holds a file names its session."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def session_column(path: Column, at: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.concat_ws("_", stem, F.date_format(at, "yyyyMMdd_HHmmss"))
