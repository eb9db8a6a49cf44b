"""MPEG audio columns: multiplex bytes into a stream, and scan any stream.

``scan`` reads MPEG-1/2/2.5 audio of layers I to III: it skips and parses ID3v2
tags, reads Xing/Info and VBRI tables (with their seek points, and an encoder's
delay and padding) and an ID3v1 trailer, resynchronises on frame headers, verifies
checksums (layers I and III; layer II checksums need allocation tables and count as
unchecked), and gives the exact duration as samples, less delay and padding, over
sample rate with the offset of every frame.  A header counts at the start and after
damage only if another of its kind, or the end, follows its frame.

``multiplex`` stores arbitrary bytes losslessly in a decodable layer III stream:
frames of silence (all part lengths 0) carry the bytes as ancillary data, behind
a two-byte count.  Frame sizes vary, so a Xing table is written as well.

Nulls: a null stream scans as an empty one (no frames, zero duration); a null
text is an empty text.  Equal rows get equal results, rows without doc_id too, and
empty tables give no rows.  Free-format frames (bitrate index 0) are not frames here.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame

from .common import documents, map_rows

# Fixed values of the MPEG audio format: kbit/s by index, by (version is 1, layer).
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}

_RATE, _RATE_INDEX, _SIDE = 32000, 2, 17
_SIZES = [144 * b * 1000 // _RATE for b in BITRATES[True, 3]]
_ROOM = [s - 4 - 2 - _SIDE - 2 for s in _SIZES]


def _crc_table() -> list[int]:
    out = []
    for b in range(256):
        c = b << 8
        for _ in range(8):
            c = (c << 1) ^ (0x8005 if c & 0x8000 else 0)
        out.append(c & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    c = 0xFFFF
    for b in data:
        c = ((c << 8) & 0xFFFF) ^ _CRC[(c >> 8) ^ b]
    return c


def _frame_heads() -> list[bytes]:
    """Header, checksum and silent side information for each bitrate index."""
    out = []
    for i in range(15):
        head = bytes([0xFF, 0xFA, i << 4 | _RATE_INDEX << 2, 0xC0])
        side = bytes(_SIDE)
        out.append(head + crc16(head[2:] + side).to_bytes(2, "big") + side)
    return out


_HEADS = _frame_heads()


def _id3v2(payload_bytes: int, frames: int) -> bytes:
    def frame(name: bytes, body: bytes) -> bytes:
        return name + _syncsafe(len(body)) + b"\0\0" + body

    body = frame(b"TLEN", b"\x03" + str((frames * 1152 * 1000) // _RATE).encode())
    body += frame(b"TXXX", b"\x03payload_bytes\0" + str(payload_bytes).encode())
    return b"ID3\x04\0\0" + _syncsafe(len(body)) + body


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def multiplex(payload: bytes) -> bytes:
    """A layer III stream at 32 kHz, mono, with checksums, that carries payload."""
    most, frames = _ROOM[14], []
    for at in range(0, len(payload), most):
        part = payload[at : at + most]
        i = next(i for i in range(1, 15) if _ROOM[i] >= len(part))
        frames.append(_HEADS[i] + len(part).to_bytes(2, "big") + part + bytes(_ROOM[i] - len(part)))
    audio = b"".join(frames)
    offsets, at = [], _SIZES[1]
    for f in frames:
        offsets.append(at)
        at += len(f)
    toc = bytes(min(255, offsets[len(frames) * p // 100] * 256 // at) if frames else 0 for p in range(100))
    xing = bytes([0xFF, 0xFB, 1 << 4 | _RATE_INDEX << 2, 0xC0]) + bytes(_SIDE)
    xing += b"Xing" + (7).to_bytes(4, "big") + len(frames).to_bytes(4, "big") + at.to_bytes(4, "big") + toc
    return _id3v2(len(payload), len(frames) + 1) + xing.ljust(_SIZES[1], b"\0") + audio


def header(data: bytes, at: int) -> tuple | None:
    """(version, layer, protected, kbit/s, sample rate, channels, mode extension, size, samples) of a frame header."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    return _header(data[at + 1], data[at + 2], data[at + 3])


_HEADER_CACHE: dict[int, tuple | None] = {}


def _header(b1: int, b2: int, b3: int) -> tuple | None:
    key = b1 << 16 | b2 << 8 | b3
    if key not in _HEADER_CACHE:
        version, layer = b1 >> 3 & 3, 4 - (b1 >> 1 & 3)
        rate, index = b2 >> 2 & 3, b2 >> 4
        got = None
        if version != 1 and layer != 4 and rate != 3 and 0 < index < 15:
            kbps, hz = BITRATES[version == 3, layer][index], RATES[version][rate]
            samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
            pad = b2 >> 1 & 1
            size = (12000 * kbps // hz + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbps // hz + pad
            got = (version, layer, not b1 & 1, kbps, hz, 1 if b3 >> 6 == 3 else 2, b3 >> 4 & 3 if b3 >> 6 == 1 else -1, size, samples)
        if len(_HEADER_CACHE) > 1 << 16:
            _HEADER_CACHE.clear()
        _HEADER_CACHE[key] = got
    return _HEADER_CACHE[key]


def _side_bytes(h: tuple) -> int:
    return (17 if h[5] == 1 else 32) if h[0] == 3 else (9 if h[5] == 1 else 17)


def _checked(h: tuple) -> int | None:
    """Bytes behind the checksum that it covers; None where that needs tables."""
    if h[1] == 3:
        return _side_bytes(h)
    if h[1] == 1:
        bound = 32 if h[6] < 0 else 4 * (h[6] + 1)
        return (bound * h[5] + (32 - bound)) * 4 // 8 if h[5] == 2 else 16
    return None


def _tags(data: bytes) -> tuple[dict[str, str], int, int]:
    """Text frames of a leading ID3v2 tag, where audio starts, and where it ends before an ID3v1 tag."""
    tags, start, end = {}, 0, len(data)
    if data[:3] == b"ID3" and len(data) >= 10:
        size = sum((data[6 + k] & 0x7F) << (21 - 7 * k) for k in range(4))
        start = min(end, 10 + size + (10 if data[5] & 0x10 else 0))
        at = 10
        while at + 10 <= min(10 + size, end) and data[at : at + 1].isalnum():
            name = data[at : at + 4].decode("latin-1")
            raw = data[at + 4 : at + 8]
            n = sum((raw[k] & 0x7F) << (21 - 7 * k) for k in range(4)) if data[3] >= 4 else int.from_bytes(raw, "big")
            body = data[at + 10 : at + 10 + n]
            if name[0] == "T" and body:
                code = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
                said = body[1:].decode(code, "replace").split("\0", 1)
                key = f"{name}:{said[0]}" if name == "TXXX" and len(said) == 2 else name
                tags[key] = said[-1].rstrip("\0")
            at += 10 + n
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        tags["ID3v1"] = data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1")
    return tags, start, end


def _variable_table(data: bytes, at: int, h: tuple) -> dict | None:
    """What a Xing, Info or VBRI table in the first frame says."""
    x = at + 4 + (2 if h[2] else 0) + _side_bytes(h) if h[1] == 3 else -1
    if x > 0 and data[x : x + 4] in (b"Xing", b"Info"):
        flags, p, out = int.from_bytes(data[x + 4 : x + 8], "big"), x + 8, {"kind": data[x : x + 4].decode()}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name] = int.from_bytes(data[p : p + 4], "big")
                p += 4
        if flags & 4:
            out["toc"] = list(data[p : p + 100])
            p += 100
        p += 4 if flags & 8 else 0
        if data[p : p + 4] in (b"LAME", b"Lavf", b"Lavc") and len(data) >= p + 24:
            both = int.from_bytes(data[p + 21 : p + 24], "big")
            out["delay"], out["padding"] = both >> 12, both & 0xFFF
        return out
    v = at + 36
    if data[v : v + 4] == b"VBRI":
        entries, scale, size, each = (int.from_bytes(data[v + k : v + k + 2], "big") for k in (18, 20, 22, 24))
        steps = [int.from_bytes(data[v + 26 + k * size : v + 26 + (k + 1) * size], "big") * scale for k in range(entries if 0 < size <= 4 else 0) if v + 26 + (k + 1) * size <= len(data)]
        return {"kind": "VBRI", "bytes": int.from_bytes(data[v + 10 : v + 14], "big"), "frames": int.from_bytes(data[v + 14 : v + 18], "big"), "seek": list(accumulate(steps)), "frames_each": each}
    return None


def _seeks_agree(vbr: dict, first: int, frames: list) -> bool:
    """Whether a table's seek points are where its frames are: at a hundredth each, or at every so many frames."""
    starts, end = [a for a, _, _ in frames], frames[-1][0] + frames[-1][1] if frames else first
    if "toc" in vbr and starts:
        total = vbr.get("bytes") or end - first
        slack = total / 256 + max(n for _, n, _ in frames)
        return all(abs(first + t * total / 256 - starts[len(starts) * p // 100]) <= slack for p, t in enumerate(vbr["toc"]))
    if vbr.get("seek") and vbr.get("frames_each"):
        steps, each = vbr["seek"], vbr["frames_each"]
        return all(abs(first + s - (starts[k * each] if k * each < len(starts) else end)) <= max(n for _, n, _ in frames) for k, s in enumerate(steps, 1))
    return True


def scan(data: bytes | None) -> dict:
    """Frames (offset, size, header), tags, variable-bitrate table, checksum counts, losses of sync, samples."""
    data = data or b""
    tags, at, end = _tags(data)
    frames, crc, vbr, lost, skipped = [], {"ok": 0, "bad": 0, "none": 0, "unchecked": 0}, None, 0, 0
    checked: dict[bytes, bool] = {}
    synced, table_at = False, 0
    while at + 4 <= end:
        h = header(data, at)
        if h and not synced:
            follows = at + h[7]
            n = header(data, follows)
            if not (follows == end or n and n[:2] == h[:2] and n[4] == h[4]):
                h = None
        if not h or at + h[7] > end:
            lost += synced
            synced = False
            nxt = data.find(b"\xff", at + 1, end)
            skipped += (nxt if nxt >= 0 else end) - at
            at = nxt if nxt >= 0 else end
            continue
        synced = True
        if not frames and vbr is None and (vbr := _variable_table(data, at, h)):
            table_at = at
            at += h[7]
            continue
        if not h[2]:
            crc["none"] += 1
        elif (n := _checked(h)) is None:
            crc["unchecked"] += 1
        else:
            part = data[at + 2 : at + 6 + n]
            if part not in checked:
                checked[part] = crc16(part[:2] + part[4:]) == int.from_bytes(part[2:4], "big")
            crc["ok" if checked[part] else "bad"] += 1
        frames.append((at, h[7], h))
        at += h[7]
    total = sum(h[8] for _, _, h in frames)
    silent = sum((vbr or {}).get(k, 0) for k in ("delay", "padding"))
    return {
        "tags": tags, "vbr": vbr, "seeks_agree": vbr is None or _seeks_agree(vbr, table_at, frames), "frames": frames, "crc": crc, "lost": lost, "skipped": skipped + max(0, end - at),
        "samples": max(0, total - silent), "rate": frames[0][2][4] if frames else 0,
    }


def carried(data: bytes, found: dict) -> bytes:
    """The bytes that multiplex() put into the frames of a scanned stream."""
    out = []
    for at, _, h in found["frames"]:
        x = at + 4 + (2 if h[2] else 0) + _side_bytes(h)
        n = data[x] << 8 | data[x + 1]
        out.append(data[x + 2 : x + 2 + n])
    return b"".join(out)


def feature(found: dict) -> str:
    """One line: version, layer, rate, frames, exact duration, checksums, losses, agreement with the tables."""
    f, v = found["frames"], found["vbr"] or {}
    h = f[0][2] if f else (3, 0, 0, 0, 0, 0, 0, 0, 0)
    total, c = sum(s for _, s, _ in f), found["crc"]
    return (
        f"mpeg={ {3: '1', 2: '2', 0: '2.5'}[h[0]] };layer={h[1]};hz={found['rate']};channels={h[5]};frames={len(f)};"
        f"duration={found['samples']}/{found['rate']};kbps={min((x[2][3] for x in f), default=0)}-{max((x[2][3] for x in f), default=0)};"
        f"bytes={total};crc_ok={c['ok']};crc_bad={c['bad']};lost={found['lost']};vbr={v.get('kind', 'none')};"
        f"table_agrees={int(v.get('frames') == len(f))};seeks_agree={int(found['seeks_agree'])};tags={','.join(sorted(found['tags']))}"
    )


def audio_of_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as a stream, padded with bytes 0 to a positive multiple of 64."""

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            raw = [t.encode("utf-8", "surrogatepass") for t in x["text"]]
            return {"doc_id": x["doc_id"], "n_bytes": [len(b) for b in raw],
                    "media": [multiplex(b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")) for b in raw]}
        return run

    return map_rows(documents(docs, text, key), make, "doc_id long, n_bytes long, media binary", 64)


def audio_features(media: DataFrame) -> DataFrame:
    """Scan stored streams (doc_id, n_bytes, media) and read their bytes back.

    One row for each input row: the payload's length, digest and tail checksum,
    the stream's length and digest, its feature line, exact duration in
    samples, sample rate, and the offset of every frame for seeking.
    """

    def make() -> Callable[[dict], dict]:
        names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "samples", "sample_rate", "seek_offsets")

        def one(m: bytes) -> tuple:
            found = scan(m)
            p = carried(m, found)
            return (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(),
                    feature(found), found["samples"], found["rate"], [at for at, _, _ in found["frames"]])

        def run(x: dict) -> dict:
            rows = [one(m or b"") for m in x["media"]]
            return {"doc_id": x["doc_id"], "n_bytes": x["n_bytes"]} | {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return run

    return map_rows(media.select("doc_id", "n_bytes", "media"), make,
                    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
                    "media_sha256 string, feature string, samples long, sample_rate int, seek_offsets array<long>", 64)
