"""MPEG audio as a media column: bytes stored in Layer III frames, and a reader for such streams.

The writer makes a stream of MPEG-1 Layer III frames (160 kbit/s, 32 kHz, mono, with CRC) behind an ID3v2 tag and a
variable-bitrate table (a "Xing" frame with frame and byte counts and a 100-entry table of contents). A frame is silent: its side
information is zero, so its main data are ancillary bytes, and 576 of them carry payload. 576 is also the
format's unit, one granule of samples. The reader resynchronises frame headers (after a loss, one counts only if another follows it), parses
ID3v2, ID3v1 and Xing/Info/VBRI tables, verifies the frames' checksums, and gives the exact duration and the byte
offset of every frame.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 576
#: Texts that one Arrow batch of the codec holds at most; so the memory of a task follows the longest texts, not the table.
ROWS_AT_ONCE = 64

# Fixed values of the MPEG audio format: bitrates in kbit/s by version and layer, sample rates in Hz, samples a frame.
_BITRATES = {
    ("1", 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    ("1", 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    ("1", 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    ("2", 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    ("2", 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    ("2", 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
_SAMPLES = {("1", 1): 384, ("1", 2): 1152, ("1", 3): 1152, ("2", 1): 384, ("2", 2): 1152, ("2", 3): 576}
_CRC_POLYNOMIAL = 0x8005

_HEADER = bytes((0xFF, 0xFA, 0xA8, 0xC0))  # MPEG-1 Layer III, protected, 160 kbit/s, 32 kHz, no padding, mono
_FRAME = 144 * 160000 // 32000  # 720 bytes
_SIDE = 17  # bytes of side information of a mono frame


@lru_cache(1024)
def crc16(data: bytes, crc: int = 0xFFFF) -> int:
    """The checksum of the MPEG audio format over whole bytes."""
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ _CRC_POLYNOMIAL if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


def frame_header(word: int) -> tuple[int, int, int, str, int, int] | None:
    """(bytes, samples, rate, version, layer, channels) of the frame with this 32-bit header; None if it is no header."""
    if word >> 21 != 0x7FF:
        return None
    version, layer, rate_at, bitrate_at = word >> 19 & 3, 4 - (word >> 17 & 3), word >> 10 & 3, word >> 12 & 15
    if version == 1 or layer == 4 or rate_at == 3 or bitrate_at in (0, 15):
        return None
    kind = ("1" if version == 3 else "2", layer)
    rate, bits, padding, samples = _RATES[version][rate_at], _BITRATES[kind][bitrate_at] * 1000, word >> 9 & 1, _SAMPLES[kind]
    size = (12 * bits // rate + padding) * 4 if layer == 1 else samples // 8 * bits // rate + padding
    return size, samples, rate, kind[0], layer, 1 if word >> 6 & 3 == 3 else 2


def padded(text: str | None) -> tuple[int, bytes]:
    """UTF-8 length of the text (null: empty), and its bytes filled with 255 to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), raw + b"\xff" * ((-len(raw)) % UNIT or (0 if raw else UNIT))


def write_stream(payload: bytes) -> bytes:
    """The payload, a multiple of UNIT bytes, as a stream."""
    n = len(payload) // UNIT
    side = bytes(_SIDE)
    head = _HEADER + struct.pack(">H", crc16(_HEADER[2:] + side)) + side
    frames = np.zeros((n, _FRAME), np.uint8)
    frames[:, : len(head)] = np.frombuffer(head, np.uint8)
    frames[:, len(head) : len(head) + UNIT] = np.frombuffer(payload, np.uint8).reshape(n, UNIT)
    toc = bytes(int(256 * (1 + i * n // 100) / (n + 1)) for i in range(100))
    table = b"Xing" + struct.pack(">III", 7, n, (n + 1) * _FRAME) + toc
    tag = b"TXXX" + struct.pack(">I", 14) + b"\0\0\0payload\x00" + str(UNIT).encode() + b"\0\0"
    size = len(tag)
    id3 = b"ID3\x04\0\0" + bytes((size >> 21 & 127, size >> 14 & 127, size >> 7 & 127, size & 127)) + tag
    return id3 + (head + table).ljust(_FRAME, b"\0") + frames.tobytes()


def _numbers(data: bytes, width: int) -> list[int]:
    return [int.from_bytes(data[i : i + width], "big") for i in range(0, len(data) - width + 1, width)]


def read_table(frame: bytes, body: int) -> dict | None:
    """The variable-bitrate table that a frame holds instead of sound: its kind, frames and bytes (None if not given), and seek points.

    Xing and Info tables follow the side information (at `body`) and have 100 points in 256ths of the bytes; a VBRI table is at byte 36
    and has sizes of runs of frames, in bytes.
    """
    if frame[body : body + 4] in (b"Xing", b"Info"):
        flags, at, found = int.from_bytes(frame[body + 4 : body + 8], "big"), body + 8, {"kind": frame[body : body + 4].decode(), "frames": None, "bytes": None, "points": []}
        for flag, name in ((1, "frames"), (2, "bytes")):
            if flags & flag:
                found[name] = int.from_bytes(frame[at : at + 4], "big")
                at += 4
        return found | {"points": list(frame[at : at + 100])} if flags & 4 else found
    if frame[36:40] == b"VBRI":
        n, scale, width, _ = _numbers(frame[54:62], 2)
        points = _numbers(frame[62 : 62 + n * width], width) if width else []
        return {"kind": "VBRI", "frames": int.from_bytes(frame[50:54], "big"), "bytes": int.from_bytes(frame[46:50], "big"), "points": [p * scale for p in points]}
    return None


def read_id3(tag: bytes, version: int) -> list[str]:
    """Names of an ID3v2 tag's frames with their sizes in bytes, in order; it ends at padding or at a frame that isn't whole."""
    found, at, name, head = [], 0, 3 if version == 2 else 4, 6 if version == 2 else 10
    while at + head <= len(tag) and tag[at : at + name].isalnum():
        size = tag[at + name : at + name + (3 if version == 2 else 4)]
        size = sum((b & 127) << 7 * i for i, b in enumerate(reversed(size))) if version == 4 else int.from_bytes(size, "big")
        if at + head + size > len(tag):
            break
        found.append(f"{tag[at : at + name].decode('latin-1')}:{size}")
        at += head + size
    return found


def _checked_bytes(layer: int, channels: int, word: bytes, side: int) -> int:
    """How many bytes after the checksum it covers: side information in Layer III, bit allocations in Layer I; 0 in Layer II, whose tables aren't kept here."""
    if layer == 1:
        bound = 4 * ((word[3] >> 4 & 3) + 1) if word[3] >> 6 & 3 == 1 else 32
        return 16 if channels == 1 else (32 + bound) // 2
    return side if layer == 3 else 0


def _run_of_equal_frames(data: np.ndarray, at: int, size: int, word: bytes) -> int:
    """How many frames of `size` bytes with the same header follow each other from `at`."""
    n = (len(data) - at) // size
    if n <= 0:
        return 0
    heads = data[at : at + n * size].reshape(n, size)[:, :4]
    other = np.flatnonzero((heads != np.frombuffer(word, np.uint8)).any(1))
    return int(other[0]) if len(other) else n


def read_stream(media: bytes, tagged: bool = True) -> dict:
    """What the stream holds: frames, samples, rate, seconds, offsets (int64 array), tags and their frames, the table and its seek points,
    crc_ok, crc_bad, skipped, payload. Frames without a stated bitrate are no headers; Layer II checksums aren't verified.

    Never raises on broken streams: bytes between frames count as skipped, a last frame that isn't whole is left out.
    'TAG' 128 bytes before the end is no ID3v1 tag where frames without gaps fill the stream to its end.
    """
    data, at, out = np.frombuffer(media, np.uint8), 0, {"tags": [], "tag_frames": [], "table": None, "table_frames": None, "table_bytes": None, "points": [], "crc_ok": 0, "crc_bad": 0, "skipped": 0}
    end = len(media)
    if tagged and end >= 128 and media[-128:-125] == b"TAG":
        if (whole := read_stream(media, False))["frames"] and not whole["skipped"]:
            return whole
        out["tags"].append("ID3v1")
        end -= 128
    while media[at : at + 3] == b"ID3" and at + 10 <= end:
        size = media[at + 6] << 21 | media[at + 7] << 14 | media[at + 8] << 7 | media[at + 9]
        out["tags"].append(f"ID3v2.{media[at + 3]}")
        out["tag_frames"] += read_id3(media[at + 10 : min(end, at + 10 + size)], media[at + 3])
        at = min(end, at + 10 + size + (10 if media[at + 5] & 16 else 0))
    offsets, payload, samples, rate, first, synced = [], [], 0, 0, True, False
    while at + 4 <= end:
        word = media[at : at + 4]
        found = frame_header(int.from_bytes(word, "big"))
        if not found or at + found[0] > end:
            nxt = media.find(b"\xff", at + 1, end)
            nxt = end if nxt < 0 else nxt
            out["skipped"], at, synced = out["skipped"] + nxt - at, nxt, False
            continue
        size = found[0]
        if not synced:  # headers that happen to look right are told by what follows
            nxt = at + size
            if nxt + 4 <= end and (media[nxt] != 0xFF or not frame_header(int.from_bytes(media[nxt : nxt + 4], "big"))):
                out["skipped"], at = out["skipped"] + 1, at + 1
                continue
            synced = True
        protected = not word[1] & 1
        side = (17 if found[5] == 1 else 32) if found[3] == "1" else (9 if found[5] == 1 else 17)
        body = 4 + 2 * protected + side
        if first:
            first = False
            if table := read_table(media[at : at + size], body):
                out |= {"table": table["kind"], "table_frames": table["frames"], "table_bytes": table["bytes"], "points": table["points"]}
                at += size
                continue
        n = _run_of_equal_frames(data[:end], at, size, word)
        block = data[at : at + n * size].reshape(n, size)
        covered = _checked_bytes(found[4], found[5], word, side)
        if protected and covered and 6 + covered <= size:
            stored = block[:, 4].astype(np.int64) * 256 + block[:, 5]
            sides, back = np.unique(block[:, 6 : 6 + covered], axis=0, return_inverse=True)
            right = np.array([crc16(word[2:4] + s.tobytes()) for s in sides])[back.ravel()] == stored
            out["crc_ok"] += int(right.sum())
            out["crc_bad"] += int(n - right.sum())
        offsets.append(at + size * np.arange(n, dtype=np.int64))
        payload.append(block[:, body : body + UNIT].tobytes())
        samples, rate, at = samples + n * found[1], found[2], at + n * size
    out["skipped"] += max(0, end - at)
    out["offsets"] = np.concatenate(offsets) if offsets else np.empty(0, np.int64)
    out |= {"frames": len(out["offsets"]), "samples": samples, "rate": rate, "seconds": samples / rate if rate else 0.0, "payload": b"".join(payload)}
    return out


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for i in range(0, len(b), ROWS_AT_ONCE):
            part = b.iloc[i : i + ROWS_AT_ONCE]
            made = [padded(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": [n for n, _ in made], "media": [write_stream(p) for _, p in made]})


def encode_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (binary): every document's whole text as a stream; null text is stored as the empty one.

    Repeated rows make equal streams, a null doc_id stays null. Other columns aren't read. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(_encode, "doc_id long, n_bytes long, media binary")


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames long, samples long, seconds double, crc_ok long, crc_bad long, skipped long, seek_offsets array<long>"


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, n, media in zip(b["doc_id"], b["n_bytes"], b["media"], strict=True):
            media = bytes(media or b"")
            r = read_stream(media)
            p = r["payload"]
            feature = f"frames={r['frames']};samples={r['samples']};rate={r['rate']};table={r['table']}:{r['table_frames']}:{r['table_bytes']}:{zlib.crc32(str(r['points']).encode())};tags={','.join(r['tags'] + r['tag_frames'])};crc_ok={r['crc_ok']};crc_bad={r['crc_bad']};skipped={r['skipped']};first={r['offsets'][0] if r['frames'] else -1};last={r['offsets'][-1] if r['frames'] else -1}"
            rows.append((doc_id, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, r["frames"], r["samples"], r["seconds"], r["crc_ok"], r["crc_bad"], r["skipped"], r["offsets"]))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _FEATURES.split(", ")]).astype({"doc_id": "Int64", "n_bytes": "Int64"})


def read_media(media: DataFrame) -> DataFrame:
    """What the reader finds in every stream of (doc_id, n_bytes, media); null media count as an empty stream.

    Repeated rows give equal rows. Other columns aren't read. An empty table gives an empty result.
    """
    return media.select("doc_id", "n_bytes", "media").mapInPandas(_decode, _FEATURES)
