import pytest
from pyspark.sql import functions as F

from cuewright.plans import polish
from cuewright.sources import subtitles

GOOD = "1\n00:00:01,000 --> 00:00:02,000 X1:10\nHola\n\n2\n00:00:03,000 --> 00:00:04,000\n\n a  b\nc\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("srt")
    (path / "good.srt").write_text(GOOD)
    (path / "marked.srt").write_bytes(b"\xef\xbb\xbf" + GOOD.replace("\n", "\r\n").encode())
    (path / "latin.srt").write_bytes(GOOD.replace("Hola", "Señor").rstrip("\n").encode("cp1252"))
    (path / "wide.srt").write_bytes(GOOD.encode("utf-16"))
    (path / "bad.srt").write_text("no index\n\n" + GOOD)
    (path / "empty.srt").write_text("\n\n")
    (path / "signs.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\n...\n")
    return path


def report(p):
    return {r.title: (r.status, r.reason) for r in p.report.collect()}


def texts(p):
    return {r.title: r.text for r in p.files.collect()}


REFUSED = {"bad": ("refused", "malformed"), "empty": ("refused", "no-cues")}


def test_reencode_only(spark, folder):
    """Bytes change, cues don't; what is fine stays untouched, and what doesn't parse is refused."""
    p = polish.polish(subtitles.raw_files(spark, str(folder)), reencode_only=True)
    assert report(p) == REFUSED | {"good": ("untouched", None), "signs": ("untouched", None), "marked": ("reencoded", None), "latin": ("reencoded", None), "wide": ("reencoded", None)}
    assert texts(p) == {"marked": GOOD, "wide": GOOD, "latin": GOOD.replace("Hola", "Señor")}


def test_shift(spark, folder):
    p = polish.polish(subtitles.raw_files(spark, str(folder)).where("title in ('good', 'bad')"), shift_ms=-2500)
    got = {r.title: (r.status, r.cues, r.clamped, r.new_overlaps) for r in p.report.collect()}
    assert got == {"good": ("moved", 2, 1, 1), "bad": ("refused", None, None, None)}
    assert texts(p) == {"good": "1\n00:00:00,000 --> 00:00:01,000 X1:10\nHola\n\n2\n00:00:00,500 --> 00:00:01,500\n\n a  b\nc\n"}


def test_a_shift_that_would_alter_more_is_refused(spark):
    """A timestamp line that reads as a cue's but isn't the anchored form stays, and so the file is not written."""
    text = GOOD.replace("2\n00:00:03,000", "2\nat 00:00:03,000")
    df = spark.createDataFrame([("t", text, "utf-8", "/x")], "title string, text string, encoding string, path string")
    p = polish.surgical(df, 1000)
    assert report(p)["t"][0] == "refused" and texts(p) == {}


def test_full_and_dry_run(spark, folder, tmp_path):
    files = subtitles.raw_files(spark, str(folder)).where("title in ('marked', 'bad', 'signs')")
    p = polish.polish(files)
    assert report(p) == {"marked": ("polished", None), "bad": ("refused", "malformed"), "signs": ("refused", "nothing-left")}
    assert p.deliver(str(tmp_path), dry_run=True) == [] and not list(tmp_path.iterdir())
    assert p.deliver(str(tmp_path), suffix=".out.srt") == ["marked"]
    assert (tmp_path / "marked.out.srt").read_text() == "1\n00:00:01,000 --> 00:00:02,000\nHola\n\n2\n00:00:03,000 --> 00:00:04,000\na b c\n"
    assert p.report.where(F.col("title") == "marked").first().rewrapped == 1
