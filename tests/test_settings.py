"""Settings as projects have them: values of a language pack and of a project, the values they come to, and what is refused."""

import copy

import pytest
from pyspark.sql import functions as F

from cuewright.functions.rules import BOILERPLATE, SENSES, Options, Rewrite, Sense, rewritten
from cuewright.functions.text import SOUND_WORDS
from cuewright.operators import validate
from cuewright.sources import settings

YAML_PACK = r"""
target_code: es-419
target_name: "Español (Latinoamérica)"
banned:
  terms: [vosotros, gilipollas, coño, 'jod\w*', ordenador, coger, '\w+áis', '\w+éis', sois, vais, güey, malditamente]
  caution: [móvil, hostia, pinche, 'entrant\w+']
  phrases: ['puta\s+madre', 'me\s+vale\s+madres', 'caer\s+el\s+veinte']
  context_exempt:
    - { term: 'tío', sense: family }
    - { term: 'tía', sense: family }
    - { term: 'vale', sense: valer }
profanity_map:
  - { src: "piss off", tgt: "vete", note: "" }
autofix:
  - { type: word, find: "cabrón", replace: "desgraciado" }
profanity: { intensity: match-source, keep_compound_insults: true, prefer_sarcasm_over_calque: true }
leftover_source_markers: [the, you, "you're", what, right, ok]
kept_loanwords: [Chef]
sdh:
  drop_pure_sound: true
  inaudible_render: "[ininteligible]"
  strip_speaker_labels: true
  sound_words: [Music, cheer]
foreign_speech: { policy: translate-and-italicize, keep_in_language_italic: [Italian, French], never_italicize_target: true }
readability: { max_cps: 17, hard_cps: 26, max_cpl: 42, max_lines: 2, min_duration: 0.7, min_gap: 0.0 }
encoding: { utf8_no_bom: true, forbid_literal_newline_escapes: true, forbid_mojibake: true }
"""
YAML_PROJECT = r"""
project_name: "Example Show (2025)"
source_language: en
target: { guardrails: es-419, srt_suffix: ".es-419.srt" }
paths: { media_root: "D:/Media/Example Show", work_dir: "work" }
layout: { kind: episodic, title_regex: 'S(?P<season>\d{2})E(?P<ep>\d{2})', video_globs: ["*.mkv", "*.mp4"] }
slices_per_title: 4
streams: { prefer_language: en, prefer_sdh: true, allow_forced: false, exclude_commentary: true }
register: { default_second_person: "tú", notes: "Family = tú." }
units: { road_distance: imperial, felt_quantities: metric, notes: "" }
named_entities_keep_verbatim: ["Minneapolis", "Modafinil -> Modafinilo"]
readability:
asr: { strip_hallucinations: true, hallucination_min_repeats: 3, hallucination_extra_patterns: [] }
features: { allow_merge: false, gate_b_sample_lock: true, burnin_recovery: false }
catchphrases: []
glossary: "glossary.md"
"""


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    pytest.importorskip("yaml")
    folder = tmp_path_factory.mktemp("settings")
    out = []
    for name, text in (("project", YAML_PROJECT), ("pack", YAML_PACK)):
        (folder / f"{name}.yaml").write_text(text)
        out.append(settings.read(spark, f"{folder}/{name}.yaml"))
    return out


def test_effective_values(both):
    got = settings.settings(*both)
    assert got.options == Options(42, 2, 17, 26, 700, 3, True, False, True, "[ininteligible]")
    assert (got.source_language, got.target_code, got.target_name, got.srt_suffix, got.slices) == ("en", "es-419", "Español (Latinoamérica)", ".es-419.srt", 4)
    assert got.fixes == [Rewrite("cabrón", "desgraciado")] and got.patterns == list(BOILERPLATE)
    assert got.pack.exempt == (("tío", SENSES["family"]), ("tía", SENSES["family"]), ("vale", SENSES["valer"]))
    assert got.pack.entities == (("Minneapolis", "Minneapolis"), ("Modafinil", "Modafinilo")) and got.pack.loanwords == ("chef",)
    assert got.sound_words == ("music", "cheer") and got.raw["foreign_speech"]["policy"] == "translate-and-italicize"
    assert got.streams == settings.Streams("en", True, False, True, {}) and got.features == {"allow_merge": False, "gate_b_sample_lock": True, "burnin_recovery": False}
    assert settings.settings({}, {}).options == Options() and settings.settings({}, {}).sound_words == SOUND_WORDS


def test_a_project_overrides_its_pack(both):
    project, pack = copy.deepcopy(both)
    project["readability"] = {"max_cpl": 38, "min_duration": 1}
    project["foreign_speech"] = {"policy": "preserve-source-tag-set"}
    project["target"] = {"guardrails": "es-419", "code": "es-MX", "name": "Español (México)"}
    project["features"] = {"allow_merge": True}
    project["asr"] = {"strip_hallucinations": False, "hallucination_min_repeats": 5, "hallucination_extra_patterns": [r"brought to you by .*"], "hallucination_patterns_replace": True}
    project["catchphrases"] = [{"match_type": "Word", "find": "downtown", "replace": "el centro"}, {"match_type": "regex", "find": r"\bMr\. (?=[A-Z])", "replace": "Sr. "}]
    project["streams"] = {"index_override": {"the-film-2025": 3, 7: 1}}
    pack["sdh"] = {"drop_pure_sound": False}
    got = settings.settings(project, pack)
    assert (got.options.max_cpl, got.options.max_lines, got.options.min_duration_ms, got.options.min_repeats) == (38, 2, 1000, 5)
    assert not got.options.strip_boilerplate and got.options.allow_merge and not got.options.drop_pure_sound and got.options.inaudible == Options.inaudible
    assert got.patterns == ["brought to you by .*"] and [f.kind for f in got.fixes] == ["word", "word", "regex"]
    assert (got.target_code, got.target_name, got.srt_suffix) == ("es-MX", "Español (México)", ".es-MX.srt")
    assert got.raw["foreign_speech"] == {"policy": "preserve-source-tag-set", "keep_in_language_italic": ["Italian", "French"], "never_italicize_target": True}
    assert got.streams.index_override == {"the-film-2025": 3, 7: 1} and got.streams.language == "en"


@pytest.mark.parametrize(("where", "value", "match"), [
    (("project", "asr", "hallucination_patterns_replace"), "false", "project.asr.hallucination_patterns_replace must be bool"),
    (("project", "asr", "strip_hallucinations"), "no", "strip_hallucinations must be bool"), (("project", "asr"), False, "project.asr must be a mapping"),
    (("project", "asr", "hallucination_min_repeats"), True, "min_repeats must be int"), (("project", "asr", "hallucination_min_repeats"), 0, "must be at least 1"),
    (("project", "asr", "hallucination_extra_patterns"), "abc", "must be a list"), (("project", "asr", "hallucination_extra_patterns"), ["("], "extra pattern 0"),
    (("project", "asr", "hallucination_patterns"), ["x"], "project.asr has no key 'hallucination_patterns'"), (("project", "readabilty"), {}, "project has no key 'readabilty'"),
    (("project", "readability"), {"min_duration": "0.7"}, "project.readability.min_duration must be float"), (("project", "readability"), {"max_cps": 0}, "max_cps must be more than 0"),
    (("project", "layout", "kind"), "series", "must be one of episodic, movie"), (("project", "slices_per_title"), 0, "slices_per_title must be at least 1"),
    (("project", "catchphrases"), [{"type": "glob", "find": "a", "replace": "b"}], r"catchphrases\[0\].type must be one of"),
    (("pack", "banned", "context_exempt"), [{"term": "vale", "sense": "valor"}], "must be one of family, valer"), (("pack", "banned", "context_exempt"), [{"sense": "valer"}], "names no term"),
    (("pack", "kept_loanwords"), "chef", "pack.kept_loanwords must be a list"), (("pack", "sdh", "drop_pure_sound"), 1, "must be bool")])
def test_slips_are_refused(both, where, value, match):
    said = dict(zip(("project", "pack"), copy.deepcopy(both), strict=True))
    at = said
    for k in where[:-1]:
        at = at[k]
    at[where[-1]] = value
    with pytest.raises(ValueError, match=match):
        settings.settings(said["project"], said["pack"])


def test_senses_by_occurrence(spark, both):
    """Family and valer as the pack means them; each occurrence has its own neighbours, and the first wrong one is said."""
    pack = settings.settings(*both).pack
    cases = {
        "mi tío Juan": None, "El tío dijo": None, "¡Tío, ven!": "Tío", "oye tío Juan": None, "oye, tío": "tío", "su tío, tío": "tío", "tío Pepe y tío": "tío", "nuestra TÍA viene": None, "una tía, la TÍA": None,
        "vale la pena": None, "Más vale tarde": None, "Vale.": "Vale", "no vale nada, ¿vale?": "vale", "vale mucho": None, "eso vale, la verdad": "vale", "¡vale! La vida": "vale", "te vale": None, "equivale": None, "tíos": None, "vale": "vale"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", pack.exempt_violation(F.col("t")).alias("hit"))
    assert {r.t: r.hit for r in df.collect()} == cases
    own = settings.pack({"banned": {"context_exempt": [{"term": "gambas?", "before": ["las"]}, {"term": "x", "sense": "mine"}]}}, senses={"mine": Sense(after=("y",))})
    df = spark.createDataFrame([("las gambas", ), ("gamba x y x z",)], "t string").select(own.exempt_violations(F.col("t")).alias("hits"))
    assert [r.hits for r in df.collect()] == [[], ["gamba", "x"]]


def test_terms_phrases_and_cautions(spark, both):
    """Terms are regexes between borders, phrases have none, cautions are regexes too; a fix keeps a capital."""
    got = settings.settings(*both)
    cases = {"El ordenador": ("ordenador", None), "superordenadores": (None, None), "habláis": ("habláis", None), "un país": (None, None), "reputa   madreselva": ("puta   madre", None), "JODER": ("JODER", None),
             "un móvil": (None, "móvil"), "llamadas entrantes": (None, "entrantes"), "automóvil": (None, None)}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", got.pack.banned_hit(F.col("t")).alias("b"), got.pack.caution_hit(F.col("t")).alias("c"))
    assert {r.t: (r.b, r.c) for r in df.collect()} == cases
    fixed = spark.createDataFrame([("Cabrón, cabrón y cabrones",)], "t string").select(rewritten(F.col("t"), got.fixes).alias("r")).first().r
    assert fixed == "Desgraciado, desgraciado y cabrones"


def test_the_marker_of_the_language(spark, both):
    opt = settings.settings(*both).options
    target = spark.createDataFrame([("t", 1, "x", "[ininteligible] sí"), ("t", 2, "x", "[inaudible] no")], "title string, num int, ts string, text string")
    made = target.select("title", F.col("num").alias("out"), F.array("num").alias("src"), "ts", F.lit(False).alias("drop"))
    source = target.select("title", "num", F.lit("[inaudible]").alias("text"), F.lit(False).alias("droppable"), F.lit(True).alias("inaudible"))
    found = validate.manifest_findings(target, made, source, marker=opt.inaudible).collect()
    assert [(r.num, r.rule, r.detail) for r in found] == [(2, "inaudible-marker", "[ininteligible]")]
    files = spark.createDataFrame([("t", "[ininteligible] sí"), ("u", "[inaudible] no"), ("v", "[two\nlines]")], "title string, text string")
    none = spark.createDataFrame([], "title string")
    tags = validate.source_findings(files, none, files, marker=opt.inaudible).where("rule = 'bracket-tag'")
    assert sorted(r.title for r in tags.collect()) == ["u", "v"]


def test_titles_of_both_layouts(spark):
    movie = settings.settings({"layout": {"kind": "movie", "titles": [{"key": "b", "video": "B (2025).mkv"}, {"key": "a", "video": "A.mkv"}]}, "paths": {"media_root": "/m/"}}, {}).layout
    assert [tuple(r) for r in movie.found(spark).orderBy("pos").collect()] == [(1, "b", "/m/B (2025).mkv"), (2, "a", "/m/A.mkv")]
    for titles, match in (([], "names no title"), ([{"key": "a", "video": "x"}] * 2, "listed twice")):
        with pytest.raises(ValueError, match=match):
            settings.settings({"layout": {"kind": "movie", "titles": titles}}, {}).layout.found(spark)
    paths = spark.createDataFrame([("/m/show.S02E05.mkv",), ("/m/other.mkv",), ("/n/show.S02E05.mkv",)], "path string")
    series = settings.settings({"layout": {"title_regex": r"S(?P<season>\d{2})E(?P<ep>\d{2})"}}, {}).layout
    assert [tuple(r) for r in series.found(spark, paths).collect()] == [("S02E05", "/m/show.S02E05.mkv")]
    plain = settings.settings({"layout": {"title_regex": r"show\.S\d+"}}, {}).layout
    assert [r.title for r in plain.found(spark, paths).collect()] == ["show.S02"]
    with pytest.raises(ValueError, match="title_regex"):
        settings.settings({}, {}).layout.found(spark, paths)
    assert settings.settings({"streams": {"index_override": {"a": 3}}}, {}).streams.overrides(spark).first()[:] == ("a", 3)
