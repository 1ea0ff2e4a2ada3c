"""The five programs as commands: ``python -m framelake.plans.commands extract --input walk.avi --output-dir out``.

A path to one session's document stands for the folder that holds all sessions, as every program works on all of them.
Arguments that are not given come from the settings file, if one is named, or its defaults.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from framelake import settings as S
from framelake.operators import raster
from framelake.plans import programs

DICTIONARY = {"choices": sorted(S.DICTIONARIES), "help": "marker dictionary"}
WORDS = {"metavar": "FILE", "help": "table of the dictionary's code words, a line for each marker; without it words are made by rule"}
#: The programs' arguments: flag -> what argparse is told.
ARGUMENTS: dict[str, dict[str, dict]] = {
    "extract": {"--input": {"required": True, "help": "video file, or a pattern of such"}, "--stride": {"type": int, "help": "take one of so many frames"}, "--output-dir": {"default": "data/frames", "help": "folder of the sessions"}},
    "detect": {"--metadata": {"required": True, "help": "a session's metadata.json, or the folder of the sessions"}, "--dictionary": DICTIONARY, "--words": WORDS},
    "choose": {"--detections": {"required": True, "help": "a session's detections.json, or the folder of the sessions"}, "--min-markers": {"type": int, "help": "least number of markers of a kept frame"}, "--valid-ids": {"type": int, "nargs": "+", "metavar": "ID", "help": "markers that count; others are left out first"}},
    "mask": {"--manifest": {"required": True, "help": "a session's manifest.json, or the folder of the sessions"}, "--text-prompt": {"help": "what the detector looks for, in lower case, with a full stop at its end"}, "--device": {"choices": list(S.DEVICES), "help": "where the tracker runs"}},
    "sheet": {"--num-markers": {"type": int}, "--side-pixels": {"type": int}, "--margin-pixels": {"type": int}, "--dictionary": DICTIONARY, "--words": WORDS, "--dpi": {"type": int}, "--output-dir": {"default": "data/markers", "help": "folder of the sheet"}, "--page-format": {"choices": sorted(S.PAGES)}},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="framelake", description=__doc__)
    each = top.add_subparsers(dest="program", required=True)
    for name, flags in ARGUMENTS.items():
        own = each.add_parser(name)
        for flag, told in flags.items():
            own.add_argument(flag, **told)
        own.add_argument("--config", metavar="FILE", help="settings file (YAML)")
        if name in ("detect", "choose", "mask"):
            own.add_argument("--rejected", metavar="FOLDER", help="where broken documents are listed; without it the first one is an error")
    return top


def sessions(path: str) -> str:
    """The folder of the sessions, from itself or a session's document."""
    return path.rstrip("/").rsplit("/", 2)[0] if path.endswith(".json") and path.count("/") >= 2 else "." if path.endswith(".json") else path.rstrip("/")


def words(given: str | None, dictionary: str):
    bits, count = S.DICTIONARIES[dictionary][1:]
    return raster.words_from(given) if given else raster.code_words(bits, count)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Runs one program; arguments are checked before a session is asked for."""
    a = parser().parse_args(argv)
    own = S.load(a.config)
    device = S.device(S.first_given(getattr(a, "device", None), own.mask_generation.device)) if a.program == "mask" else None
    S.configure_logging()
    spark = spark or SparkSession.builder.appName(f"framelake {a.program}").getOrCreate()
    if a.program == "extract":
        programs.extract(spark, a.input, a.output_dir, a.stride, own)
    elif a.program == "detect":
        programs.detect(spark, sessions(a.metadata), words(a.words, S.first_given(a.dictionary, own.dictionary)), a.dictionary, own, a.rejected)
    elif a.program == "choose":
        programs.choose(spark, sessions(a.detections), a.min_markers, a.valid_ids, own, a.rejected)
    elif a.program == "mask":
        programs.mask(spark, sessions(a.manifest), rejected=a.rejected, device=device)
    else:
        programs.sheet(spark, a.output_dir, words(a.words, S.first_given(a.dictionary, own.markers.dictionary)), a.num_markers, a.side_pixels, a.margin_pixels, a.dictionary, a.dpi, a.page_format, own)


if __name__ == "__main__":
    main()
