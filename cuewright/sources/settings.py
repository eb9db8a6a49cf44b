"""Project settings and language packs, from mappings, JSON or YAML files; read on the driver, where plans are built.

``PROJECT`` and ``LANGUAGE`` say which keys there are and what their values may be.
What is not there is refused, and so is a quoted boolean or a number as text: a slip
must not silently turn a rule off.  A null value says nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import SENSES, Options, Pack, Rewrite, Sense, boilerplate_patterns, rewrites
from ..functions.text import SOUND_WORDS
from . import subtitles

# ---- shapes: a type, a list of a shape, a mapping of keys to shapes, a tuple of allowed values, ANY -----------------

ANY = object()
NUMBER = (int, float)
RULE = {"type": ("word", "regex"), "match_type": ("word", "regex"), "find": str, "replace": str}
READABILITY = {"max_cps": NUMBER, "hard_cps": NUMBER, "max_cpl": int, "max_lines": int, "min_duration": NUMBER, "min_gap": NUMBER}
SPEECH = {"policy": str, "keep_in_language_italic": [str], "never_italicize_target": bool}

PROJECT: dict[str, Any] = {
    "project_name": str, "source_language": str, "target": {"guardrails": str, "code": str, "name": str, "srt_suffix": str}, "paths": {"media_root": str, "work_dir": str},
    "layout": {"kind": ("episodic", "movie"), "title_regex": str, "video_globs": [str], "titles": [{"key": str, "video": str}]}, "slices_per_title": int,
    "streams": {"prefer_language": str, "prefer_sdh": bool, "allow_forced": bool, "exclude_commentary": bool, "index_override": {ANY: int}},
    "register": {"default_second_person": str, "notes": str}, "units": {"road_distance": str, "felt_quantities": str, "notes": str}, "named_entities_keep_verbatim": [str], "readability": READABILITY,
    "asr": {"strip_hallucinations": bool, "hallucination_min_repeats": int, "hallucination_extra_patterns": [str], "hallucination_patterns_replace": bool},
    "features": {"allow_merge": bool, "gate_b_sample_lock": bool, "burnin_recovery": bool}, "foreign_speech": SPEECH, "catchphrases": [RULE], "glossary": str,
}
LANGUAGE: dict[str, Any] = {
    "target_code": str, "target_name": str, "banned": {"terms": [str], "caution": [str], "phrases": [str], "context_exempt": [{"term": str, "sense": str, "before": [str], "after": [str], "capital": bool}]},
    "profanity_map": [{"src": str, "tgt": str, "note": str}], "autofix": [RULE], "profanity": {"intensity": str, "keep_compound_insults": bool, "prefer_sarcasm_over_calque": bool},
    "leftover_source_markers": [str], "kept_loanwords": [str], "sdh": {"drop_pure_sound": bool, "inaudible_render": str, "strip_speaker_labels": bool, "sound_words": [str]},
    "foreign_speech": SPEECH, "readability": READABILITY, "encoding": {"utf8_no_bom": bool, "forbid_literal_newline_escapes": bool, "forbid_mojibake": bool},
}


def checked(value: Any, shape: Any, where: str) -> Any:
    """``value`` without what is null; raises where it doesn't have the shape, and names the place."""
    if shape is ANY:
        return value
    if isinstance(shape, dict):
        if not isinstance(value, Mapping):
            raise ValueError(f"{where} must be a mapping, not {value!r}")
        if unknown := [k for k in value if k not in shape and ANY not in shape]:
            raise ValueError(f"{where} has no key {unknown[0]!r}")
        return {k: checked(v, shape.get(k, shape.get(ANY)), f"{where}.{k}") for k, v in value.items() if v is not None}
    if isinstance(shape, list):
        if not isinstance(value, (list, tuple)):
            raise ValueError(f"{where} must be a list, not {value!r}")
        return [checked(v, shape[0], f"{where}[{i}]") for i, v in enumerate(value)]
    kinds = shape if isinstance(shape, tuple) else (shape,)
    if isinstance(kinds[0], str):
        if not isinstance(value, str) or value.lower() not in kinds:
            raise ValueError(f"{where} must be one of {', '.join(kinds)}, not {value!r}")
        return value.lower()
    if not isinstance(value, kinds) or (isinstance(value, bool) and bool not in kinds):
        raise ValueError(f"{where} must be {kinds[-1].__name__}, not {value!r}")
    return value


def merged(base: Mapping[str, Any], over: Mapping[str, Any] | None) -> dict[str, Any]:
    """``base`` with what ``over`` says: mappings are merged, other values replaced, and null says nothing."""
    said = {k: v for k, v in (over or {}).items() if v is not None}
    both = {k: merged(base[k], v) for k, v in said.items() if isinstance(v, Mapping) and isinstance(base.get(k), Mapping)}
    return {**base, **said, **both}


def read(spark: SparkSession, path: str) -> dict[str, Any]:
    """A JSON or YAML file on any store Spark reads; an empty file has no settings."""
    text = spark.sparkContext.wholeTextFiles(path).values().first()
    if path.endswith(".json"):
        got = json.loads(text or "{}")
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML settings need PyYAML; JSON settings need nothing") from e
        got = yaml.safe_load(text)
    if got is None:
        return {}
    if not isinstance(got, Mapping):
        raise ValueError(f"{path}: settings must be a mapping, not {type(got).__name__}")
    return dict(got)


def pack(section: Mapping[str, Any], entities: list[str] | tuple[str, ...] = (), senses: Mapping[str, Sense] = SENSES) -> Pack:
    """A language pack's rules.  An entity is ``name`` or ``source -> target``; an exempt term names a sense, or its own contexts."""
    said = checked(section, LANGUAGE, "pack")
    banned = said.get("banned", {})
    exempt = []
    for i, c in enumerate(banned.get("context_exempt", [])):
        if "term" not in c:
            raise ValueError(f"pack.banned.context_exempt[{i}] names no term")
        if "sense" in c and c["sense"] not in senses:
            raise ValueError(f"pack.banned.context_exempt[{i}].sense must be one of {', '.join(senses)}, not {c['sense']!r}")
        named = senses[c["sense"]] if "sense" in c else Sense()
        own = Sense((*named.before, *c.get("before", ())), (*named.after, *c.get("after", ())), named.capital or c.get("capital", False))
        exempt.append((c["term"], own))
    pairs = []
    for e in entities:
        have, _, want = (x.strip() for x in e.partition("->"))
        pairs.append((have, want or have))
    return Pack(banned=tuple(banned.get("terms", ())), phrases=tuple(banned.get("phrases", ())), caution=tuple(banned.get("caution", ())), leftover=tuple(said.get("leftover_source_markers", ())),
                loanwords=tuple(w.lower() for w in said.get("kept_loanwords", ())), exempt=tuple(exempt), entities=tuple(pairs))


@dataclass(frozen=True)
class Streams:
    """How a source stream is chosen; ``index_override`` decides for a title."""

    language: str = "en"
    sdh: bool = True
    allow_forced: bool = False
    exclude_commentary: bool = True
    index_override: Mapping[str, int] = field(default_factory=dict)

    def overrides(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(str(k), v) for k, v in self.index_override.items()], "title string, index int")


@dataclass(frozen=True)
class Layout:
    """Where titles come from: a pattern on the names of files, or a list."""

    kind: str = "episodic"
    root: str = "."
    title_regex: str | None = None
    video_globs: tuple[str, ...] = ("*.mkv", "*.mp4")
    titles: tuple[Mapping[str, str], ...] = ()

    def found(self, spark: SparkSession, paths: DataFrame | None = None) -> DataFrame:
        """(title, path): of the list, or of (path) by the pattern's groups ``season`` and ``ep`` or its whole match."""
        if self.kind == "movie":
            return subtitles.listed(spark, self.titles, self.root)
        if not self.title_regex:
            raise ValueError("project.layout.title_regex is needed where titles are found by name")
        import re

        groups = re.compile(self.title_regex).groupindex
        java = self.title_regex.replace("(?P<", "(?<")
        both = {"season", "ep"} <= set(groups)
        return subtitles.discovered(paths, java, *((groups["season"], groups["ep"]) if both else ()))[0]


@dataclass(frozen=True)
class Settings:
    """What a project over its language comes to."""

    pack: Pack
    options: Options
    fixes: list[Rewrite]
    patterns: list[str]
    streams: Streams
    layout: Layout
    source_language: str
    target_code: str
    target_name: str
    srt_suffix: str
    slices: int
    sound_words: tuple[str, ...]
    features: Mapping[str, bool]
    raw: Mapping[str, Any]


#: Names of options in settings, what they are here, and what a unit of theirs is in ours.
_OPTIONS = {"max_cpl": ("max_cpl", None), "max_lines": ("max_lines", None), "max_cps": ("max_cps", None), "hard_cps": ("hard_cps", None), "min_duration": ("min_duration_ms", 1000)}
FEATURES = {"allow_merge": False, "gate_b_sample_lock": True, "burnin_recovery": False}


def settings(project: Mapping[str, Any], language: Mapping[str, Any], senses: Mapping[str, Sense] = SENSES) -> Settings:
    """A project over its language pack: readability and foreign speech are merged, the pack's fixes come before the project's."""
    mine, theirs = checked(project, PROJECT, "project"), checked(language, LANGUAGE, "pack")
    whole = theirs | {k: merged(theirs.get(k, {}), mine.get(k)) for k in ("readability", "foreign_speech")}
    options: dict[str, Any] = {}
    for name, (ours, unit) in _OPTIONS.items():
        if name in whole["readability"]:
            options[ours] = whole["readability"][name] if unit is None else round(whole["readability"][name] * unit)
    asr, features, sdh, target = (x.get(k, {}) for x, k in ((mine, "asr"), (mine, "features"), (theirs, "sdh"), (mine, "target")))
    for section, name, ours in ((asr, "strip_hallucinations", "strip_boilerplate"), (asr, "hallucination_min_repeats", "min_repeats"), (features, "allow_merge", "allow_merge"),
                                (sdh, "drop_pure_sound", "drop_pure_sound"), (sdh, "inaudible_render", "inaudible")):
        if name in section:
            options[ours] = section[name]
    source = mine.get("source_language", "en")
    code = target.get("code", theirs.get("target_code", target.get("guardrails", "")))
    streams = mine.get("streams", {})
    slices = mine.get("slices_per_title", 4)
    if slices < 1:
        raise ValueError("project.slices_per_title must be at least 1")
    layout = mine.get("layout", {})
    return Settings(
        pack=pack(theirs, mine.get("named_entities_keep_verbatim", ()), senses), options=Options.read(options), fixes=rewrites([*theirs.get("autofix", ()), *mine.get("catchphrases", ())]),
        patterns=boilerplate_patterns(asr.get("hallucination_extra_patterns"), asr.get("hallucination_patterns_replace", False)),
        streams=Streams(streams.get("prefer_language", source), *(streams.get(k, d) for k, d in (("prefer_sdh", True), ("allow_forced", False), ("exclude_commentary", True))), streams.get("index_override", {})),
        layout=Layout(layout.get("kind", "episodic"), mine.get("paths", {}).get("media_root", "."), layout.get("title_regex"), tuple(layout.get("video_globs", Layout.video_globs)), tuple(layout.get("titles", ()))),
        source_language=source, target_code=code, target_name=target.get("name", theirs.get("target_name", code)), srt_suffix=target.get("srt_suffix", f".{code}.srt"), slices=slices,
        sound_words=tuple(w.lower() for w in sdh.get("sound_words", SOUND_WORDS)), features=FEATURES | features, raw=whole | {k: v for k, v in mine.items() if k not in whole})
