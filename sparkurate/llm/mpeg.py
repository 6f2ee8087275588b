"""Media columns for MPEG audio: lossless payload frames, and a reader of any MPEG audio stream.

Writing: the payload is the text's UTF-8 bytes, padded with byte 255 to a positive multiple
of UNIT. Each unit becomes the ancillary data of one silent MPEG-1 layer III mono frame with a
checksum, the format's place for private bytes; every RICH_EVERY-th frame has a higher bit
rate. An ID3v2 tag, a variable-bitrate table and an ID3v1 tag go around them.

Reading (``scan``): skips and parses tags, finds frame headers and, after damage, the next
place where two headers in a row agree; checks each checksum (layers I and III; layer II would
need its allocation tables and is counted as unchecked), reads Xing, Info and VBRI tables and
holds them against the frames, and gives the exact duration as samples over a rate, and each
frame's byte offset for seeking.

Edge cases: a null or empty text is one unit of padding; bytes without any frame give zero
frames and rate 0; free-format frames (bit rate index 0) aren't frames here; a truncated last
frame isn't counted, its bytes are ``skipped_bytes``. Offsets of a text grow with that text.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkurate.llm import common

UNIT = 576
RICH_EVERY = 16

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by index (1 to 14), Hz, and sizes.
KBPS_V1 = {
    1: (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    2: (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    3: (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
}
KBPS_V2 = {
    1: (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    2: (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    3: (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
CRC_POLYNOMIAL = 0x8005
ID3V1_BYTES = 128


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        value = byte << 8
        for _ in range(8):
            value = (value << 1 ^ (CRC_POLYNOMIAL if value & 0x8000 else 0)) & 0xFFFF
        table.append(value)
    return table


_CRC = _crc_table()


@lru_cache(maxsize=4096)
def checksum(protected: bytes) -> int:
    """CRC-16 of MPEG audio, start value 0xFFFF, highest bit first."""
    value = 0xFFFF
    for byte in protected:
        value = (value << 8 & 0xFFFF) ^ _CRC[value >> 8 ^ byte]
    return value


class Header:
    """What a frame's four bytes say."""

    __slots__ = ("channels", "kind", "layer", "protected", "rate", "samples", "side", "size", "start")

    def __init__(self, version: int, layer: int, protected: bool, kbps: int, rate: int, padding: int, mode: int) -> None:
        self.kind = (version, layer, rate, protected)
        self.layer, self.rate, self.protected, self.channels = layer, rate, protected, 1 if mode == 3 else 2
        if layer == 1:
            self.samples, self.size = 384, (12000 * kbps // rate + padding) * 4
        else:
            self.samples = 576 if layer == 3 and version != 3 else 1152
            self.size = self.samples // 8 * 1000 * kbps // rate + padding
        self.side = ((17, 32) if version == 3 else (9, 17))[self.channels - 1] if layer == 3 else 0
        self.start = 4 + 2 * protected + self.side


@lru_cache(maxsize=4096)
def header(four: bytes) -> Header | None:
    """The header in four bytes, or None if they aren't one."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3)
    index, rate = four[2] >> 4, four[2] >> 2 & 3
    if version == 1 or layer == 4 or index in (0, 15) or rate == 3:
        return None
    return Header(version, layer, not four[1] & 1, (KBPS_V1 if version == 3 else KBPS_V2)[layer][index - 1], HERTZ[version][rate], four[2] >> 1 & 1, four[3] >> 6)


def _synchsafe(value: int) -> bytes:
    return bytes(value >> shift & 0x7F for shift in (21, 14, 7, 0))


def pad(raw: bytes) -> bytes:
    return raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def write(raw: bytes) -> bytes:
    """An MPEG audio stream that holds pad(raw)."""
    payload = pad(raw)
    units = len(payload) // UNIT
    text = b"\x00payload_bytes\x00" + str(len(raw)).encode()
    tag = b"TXXX" + _synchsafe(len(text)) + b"\x00\x00" + text
    front = b"ID3\x04\x00\x00" + _synchsafe(len(tag)) + tag
    silence = bytes(17)

    def head(index: int, padding: int) -> tuple[bytes, Header]:
        four = bytes((0xFF, 0xFA, index << 4 | padding << 1, 0xC0))  # version 1, layer III, checked; 44.1 kHz, mono
        return four + checksum(four[2:] + silence).to_bytes(2, "big") + silence, header(four)

    plain, rich = (tuple(head(i, p) for p in (0, 1)) for i in (11, 12))
    frames, sizes, remainder = [], [], 0
    for k in range(units):
        pair = rich if k % RICH_EVERY == RICH_EVERY - 1 else plain
        remainder += 144_000 * (224 if pair is rich else 192) % 44100
        padding, remainder = divmod(remainder, 44100)
        start, own = pair[padding]
        frames.append(start + payload[k * UNIT : (k + 1) * UNIT] + bytes(own.size - len(start) - UNIT))
        sizes.append(own.size)
    start, own = plain[0]
    total = own.size + sum(sizes)
    ends = np.cumsum([own.size, *sizes])[:-1]  # where each frame begins
    seek = bytes(min(255, int(ends[min(units - 1, units * i // 100)]) * 256 // total) for i in range(100))
    table = b"Xing" + (7).to_bytes(4, "big") + units.to_bytes(4, "big") + total.to_bytes(4, "big") + seek
    first = start + table + bytes(own.size - len(start) - len(table))
    return front + first + b"".join(frames) + (b"TAG" + b"document").ljust(ID3V1_BYTES, b"\x00")


def _id3v2(data: bytes, at: int) -> tuple[int, dict[str, str]]:
    """Where the tag at this place ends, and its text frames."""
    major, flags = data[at + 3], data[at + 5]
    size = 0
    for byte in data[at + 6 : at + 10]:
        size = size << 7 | byte & 0x7F
    body, end = data[at + 10 : at + 10 + size], at + 10 + size + (10 if flags & 0x10 else 0)
    if flags & 0x80 and major < 4:
        body = body.replace(b"\xff\x00", b"\xff")
    found: dict[str, str] = {}
    place = 0
    if flags & 0x40 and len(body) >= 4:
        place = sum(b << s for b, s in zip(body[:4], (21, 14, 7, 0), strict=True)) if major >= 4 else 4 + int.from_bytes(body[:4], "big")
    name, width = (3, 3) if major == 2 else (4, 4)
    while major in (2, 3, 4) and place + name + width <= len(body) and body[place]:
        key = body[place : place + name].decode("latin-1")
        raw = body[place + name : place + name + width]
        length = sum((b & 0x7F) << s for b, s in zip(raw, (21, 14, 7, 0), strict=True)) if major == 4 else int.from_bytes(raw, "big")
        place += name + width + (2 if major > 2 else 0)
        content = body[place : place + length]
        place += length
        if key[0] == "T" and content:
            encoding = ("latin-1", "utf-16", "utf-16-be", "utf-8")[content[0] & 3]
            parts = content[1:].decode(encoding, "replace").split("\x00")
            found[f"{key}:{parts[0]}" if key in ("TXXX", "TXX") else key] = parts[1] if key in ("TXXX", "TXX") and len(parts) > 1 else parts[0]
    return min(end, len(data)), found


def _intact(data: bytes, at: int, own: Header) -> bool:
    """Whether the frame has a checksum that can be checked, and it is right."""
    if not own.protected or own.layer == 2:
        return False
    covered = own.side or 16 * own.channels
    return checksum(data[at + 2 : at + 4] + data[at + 6 : at + 6 + covered]) == int.from_bytes(data[at + 4 : at + 6], "big")


def scan(data: bytes) -> dict:
    """Everything about a stream: see the module's text. Frame offsets leave out a table's frame."""
    out = {"rate": 0, "layer": 0, "channels": 0, "n_frames": 0, "n_samples": 0, "crc_checked": 0, "crc_failed": 0, "crc_unchecked": 0, "resyncs": 0, "skipped_bytes": 0, "table": "", "table_frames": 0, "table_bytes": 0, "table_ok": False, "vbr": False, "tags": {}, "offsets": [], "starts": []}
    n, at, first_size, table_at, seek = len(data), 0, 0, 0, b""
    stop = n
    if n >= ID3V1_BYTES and data[n - ID3V1_BYTES : n - ID3V1_BYTES + 3] == b"TAG":
        stop = n - ID3V1_BYTES
        out["tags"]["ID3v1"] = data[stop + 3 : stop + 33].rstrip(b"\x00 ").decode("latin-1")
    offsets, starts, kind = out["offsets"], out["starts"], None
    while at + 4 <= stop:
        own = header(data[at : at + 4])
        if own is None and data[at : at + 3] == b"ID3" and at + 10 <= stop:
            at, tags = _id3v2(data, at)
            out["tags"] |= tags
            continue
        after = at + own.size if own else 0
        if own and after <= stop:
            follower = header(data[after : after + 4]) if after + 4 <= stop else None
            # The next header agrees, or nothing follows, or a checksum or the stream so far speaks for the frame.
            agreed = (follower is not None and follower.kind == own.kind) or after >= stop - 3 or data[after : after + 3] == b"ID3" or (kind == own.kind and (follower is None or _intact(data, at, own)))
        if not own or after > stop or not agreed:
            # Resynchronise: the next place whose header and its follower agree.
            place = at + 1
            while True:
                place = data.find(b"\xff", place, stop)
                if place < 0:
                    place = stop
                    break
                own = header(data[place : place + 4])
                if own and place + own.size <= stop:
                    follower = header(data[place + own.size : place + own.size + 4])
                    if (follower and follower.kind == own.kind) or (place + own.size >= stop - 3 and own.kind == (kind or own.kind)):
                        break
                place += 1
            out["resyncs"] += place < stop
            out["skipped_bytes"] += place - at
            at = place
            continue
        kind = own.kind
        if own.protected and own.layer != 2:
            out["crc_checked"] += 1
            out["crc_failed"] += not _intact(data, at, own)
        elif own.protected:
            out["crc_unchecked"] += 1
        mark = data[at + own.start : at + own.start + 4]
        if not offsets and not out["table"] and own.layer == 3 and (mark in (b"Xing", b"Info") or data[at + 36 : at + 40] == b"VBRI"):
            place, table_at = at + own.start + 8, at
            if mark in (b"Xing", b"Info"):
                out["table"], flags = mark.decode(), data[place - 1]
                for bit, key in ((1, "table_frames"), (2, "table_bytes")):
                    if flags & bit:
                        out[key] = int.from_bytes(data[place : place + 4], "big")
                        place += 4
                if flags & 4:
                    seek = data[place : place + 100]
            else:
                out["table"] = "VBRI"
                out["table_bytes"], out["table_frames"] = (int.from_bytes(data[at + p : at + p + 4], "big") for p in (46, 50))
            out["rate"], out["layer"], out["channels"] = own.rate, own.layer, own.channels
        else:
            if not offsets:
                out["rate"], out["layer"], out["channels"], first_size = own.rate, own.layer, own.channels, own.size
            out["vbr"] |= abs(own.size - first_size) > (4 if own.layer == 1 else 1)
            offsets.append(at)
            starts.append(at + own.start)
            out["n_samples"] += own.samples
        at = after
    out["skipped_bytes"] += max(0, stop - at)
    out["n_frames"] = len(offsets)
    if out["table"]:
        total = at - table_at
        right = not seek or all(abs(seek[i] - min(255, (offsets[len(offsets) * i // 100] - table_at) * 256 // total)) <= 1 for i in range(100) if offsets)
        out["table_ok"] = out["table_frames"] == len(offsets) and out["table_bytes"] in (0, total) and right
    return out


def payload_of(data: bytes, found: dict) -> bytes:
    """The units that write() stored."""
    return b"".join(data[p : p + UNIT] for p in found["starts"])


MEDIA = T.StructType(
    [T.StructField(k, T.LongType()) for k in ("rate", "layer", "channels", "n_frames", "n_samples", "crc_checked", "crc_failed", "crc_unchecked", "resyncs", "skipped_bytes", "table_frames", "table_bytes")]
    + [T.StructField("table", T.StringType()), T.StructField("table_ok", T.BooleanType()), T.StructField("vbr", T.BooleanType()), T.StructField("tags", T.MapType(T.StringType(), T.StringType())), T.StructField("offsets", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())]
)
_ARROW = pa.struct(
    [(f.name, {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}.get(f.dataType.simpleString(), pa.map_(pa.string(), pa.string()))) for f in MEDIA]
)


def encode(docs: DataFrame) -> DataFrame:
    """doc_id, media binary: every whole text as a stream."""
    schema = T.StructType([common.id_field(docs), T.StructField("media", T.BinaryType())])

    def start():
        def step(batch):
            ids, texts = common.column_of(batch, "doc_id"), common.texts_of(batch)
            for at in range(0, len(texts), 512):
                yield pa.RecordBatch.from_arrays([ids[at : at + 512], pa.array([write(t.encode()) for t in texts[at : at + 512]], pa.binary())], names=["doc_id", "media"])

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def media_columns(media: DataFrame) -> DataFrame:
    """doc_id, media and a struct ``audio`` (MEDIA) with what scan() finds; a null stream has no bytes."""
    schema = T.StructType([common.id_field(media), T.StructField("media", T.BinaryType()), T.StructField("audio", MEDIA)])

    def start():
        def step(batch):
            streams = [m or b"" for m in common.column_of(batch, "media").to_pylist()]
            ids = common.column_of(batch, "doc_id")
            for at in range(0, len(streams), 512):
                part = streams[at : at + 512]
                found = [scan(m) for m in part]
                rows = [{k: v for k, v in f.items() if k != "starts"} | {"tags": list(f["tags"].items()), "payload": payload_of(m, f)} for f, m in zip(found, part, strict=True)]
                yield pa.RecordBatch.from_arrays([ids[at : at + 512], pa.array(part, pa.binary()), pa.array(rows, _ARROW)], names=["doc_id", "media", "audio"])

        return step

    return common.map_rows(media.select("doc_id", "media"), start, schema)


def digests(media: DataFrame) -> DataFrame:
    """The query's columns of a table of streams, read back from the stored bytes.

    The exact duration is duration_samples over sample_rate; frame_offsets are the frames' byte
    places in the stream, to seek to.
    """
    fields = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]
    fields += [("duration_samples", T.LongType()), ("sample_rate", T.LongType()), ("frame_offsets", T.ArrayType(T.LongType()))]
    schema = T.StructType([common.id_field(media), *[T.StructField(*f) for f in fields]])

    def start():
        def step(batch):
            rows = []
            for m in common.column_of(batch, "media").to_pylist():
                found = scan(m)
                payload = payload_of(m, found)
                feature = {k: found[k] for k in ("rate", "layer", "channels", "n_frames", "n_samples", "crc_checked", "crc_failed", "resyncs", "skipped_bytes", "table", "table_ok", "vbr")}
                rows.append((int(found["tags"].get("TXXX:payload_bytes", 0)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), json.dumps(feature, sort_keys=True), found["n_samples"], found["rate"], found["offsets"]))
            kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
            columns = [pa.array(c, kinds[f[1].simpleString()]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), *columns], names=["doc_id", *[f[0] for f in fields]])

        return step

    return common.map_rows(media.select("doc_id", "media"), start, schema)


def op3_mpeg_audio(spark, sf_dir: str) -> DataFrame:
    return digests(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
