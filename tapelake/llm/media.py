"""Media columns: ISO base media containers written, walked and read back without decoding a payload.

``mux`` stores bytes as the frames of a raw 8-bit grey track; ``probe`` walks the nested boxes of any container
column and turns its sample tables into codec, duration and keyframe byte ranges; ``extract`` reads the sample bytes
back through those tables.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import map_batches

#: Frame geometry of the stored track: 64 samples a row, 64 rows a frame; the last frame may have fewer rows.
ROW, ROWS = 64, 64
FRAME = ROW * ROWS
#: Frames a chunk, frames from one sync sample to the next, frames a second.
CHUNK, GROUP, RATE = 8, 16, 25
#: Boxes of the public container format that hold other boxes.
CONTAINERS = (b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta")
#: Boxes within boxes, and samples of a track, beyond which a container counts as broken.
DEPTH, SAMPLES = 32, 1 << 26

PROBED = (
    "status string, codec string, timescale long, duration long, seconds double, n_samples long, sample_bytes long, "
    "keyframes array<struct<offset: long, length: long, time: long>>, n_tracks int"
)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I", 8 + len(body)) + kind + body


def _full(kind: bytes, *parts: bytes) -> bytes:
    return _box(kind, b"\0\0\0\0", *parts)


def _ints(values) -> bytes:
    return np.asarray(values, dtype=">u4").tobytes()


def pad(data: bytes) -> bytes:
    """Append zero bytes up to a positive multiple of a row."""
    return data + bytes(max(ROW, -(-len(data) // ROW) * ROW) - len(data))


def write_container(payload: bytes) -> bytes:
    """One container with a raw grey video track whose frames are the payload's bytes, a multiple of ROW of them."""
    if not payload or len(payload) % ROW:
        raise ValueError(f"the payload must be a positive multiple of {ROW} bytes")
    n = -(-len(payload) // FRAME)
    sizes = [FRAME] * (n - 1) + [len(payload) - FRAME * (n - 1)]
    chunks = -(-n // CHUNK)
    head = _box(b"ftyp", b"isom", _ints([512]), b"isomiso2")
    wide = len(payload) + 16 >= 1 << 32
    media = (struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", len(payload) + 16) if wide else struct.pack(">I", len(payload) + 8) + b"mdat") + payload
    first = len(head) + (16 if wide else 8)
    offsets = np.arange(chunks, dtype=np.uint64) * CHUNK * FRAME + first
    matrix = _ints([1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30])
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", ROW, ROWS, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
    runs = [(1, min(CHUNK, n), 1)] + ([(chunks, n - CHUNK * (chunks - 1), 1)] if n > CHUNK and n % CHUNK else [])
    tables = _box(
        b"stbl",
        _full(b"stsd", _ints([1]), entry),
        _full(b"stts", _ints([1, n, 1])),
        _full(b"stss", _ints([-(-n // GROUP), *range(1, n + 1, GROUP)])),
        _full(b"stsc", _ints([len(runs), *(x for run in runs for x in run)])),
        _full(b"stsz", _ints([sizes[0], n] if len(set(sizes)) == 1 else [0, n, *sizes])),
        _full(b"co64", _ints([chunks]), offsets.astype(">u8").tobytes()) if wide else _full(b"stco", _ints([chunks, *offsets])),
    )
    info = _box(b"minf", _box(b"vmhd", b"\0\0\0\1", bytes(8)), _box(b"dinf", _full(b"dref", _ints([1]), _box(b"url ", b"\0\0\0\1"))), tables)
    track = _box(
        b"trak",
        _box(b"tkhd", b"\0\0\0\7", _ints([0, 0, 1, 0, n, 0, 0]), bytes(8), matrix, _ints([ROW << 16, ROWS << 16])),
        _box(b"mdia", _full(b"mdhd", _ints([0, 0, RATE, n]), struct.pack(">HH", 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), info),
    )
    movie = _box(b"moov", _full(b"mvhd", _ints([0, 0, RATE, n, 1 << 16]), struct.pack(">H", 256), bytes(10), matrix, bytes(24), _ints([2])), track)
    return head + media + movie


def walk(data: bytes):
    """Yield (path, start, end) of every box body in the order of the file, containers before what they hold."""
    waiting: list[tuple[int, int, tuple]] = [(0, len(data), ())]
    while waiting:
        start, end, path = waiting.pop()
        if start + 8 > end:
            continue
        size, head = int.from_bytes(data[start : start + 4], "big"), 8
        if size == 1:
            size, head = int.from_bytes(data[start + 8 : start + 16], "big"), 16
        elif size == 0:
            size = end - start
        kind = bytes(data[start + 4 : start + 8])
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} at {start} overruns what holds it")
        yield (*path, kind), start + head, start + size
        waiting.append((start + size, end, path))
        if kind in CONTAINERS:
            if len(path) == DEPTH:
                raise ValueError(f"more than {DEPTH} boxes within one another")
            waiting.append((start + head, start + size, (*path, kind)))


def _numbers(data: bytes, box: tuple[int, int], at: int, count: int, size: int = 4) -> np.ndarray:
    """``count`` unsigned numbers at ``at`` of a box body, which must hold them."""
    if box[0] + at + count * size > box[1]:
        raise ValueError("a sample table overruns its box")
    return np.frombuffer(data, dtype=f">u{size}", count=count, offset=box[0] + at).astype(np.int64)


def _counted(data: bytes, box: tuple[int, int], width: int = 1, size: int = 4) -> np.ndarray:
    """The entries of a table that says how many it has, a row of ``width`` numbers each."""
    count = int(_numbers(data, box, 4, 1)[0])
    return _numbers(data, box, 8, count * width, size).reshape(count, width)


def tracks(data: bytes) -> list[dict[bytes, tuple[int, int]]]:
    """Bodies of the boxes of each track, by kind, the first of a kind."""
    found: list[dict[bytes, tuple[int, int]]] = []
    fragments = False
    for path, start, end in walk(data):
        if path == (b"moov", b"trak"):
            found.append({})
        elif path[:2] == (b"moov", b"trak"):
            found[-1].setdefault(path[-1], (start, end))
        fragments |= path == (b"moof",)
    if fragments:
        raise ValueError("samples in movie fragments")
    if not found:
        raise ValueError("no track")
    return found


def decode_track(data: bytes, boxes: dict[bytes, tuple[int, int]]) -> dict:
    """A track's tables: codec, clock, and offset, length, start time and sync flag of each sample."""
    missing = [k.decode() for k in (b"mdhd", b"stsd", b"stts", b"stsc", b"stsz") if k not in boxes]
    if missing or not (b"stco" in boxes or b"co64" in boxes):
        raise ValueError(f"no {missing or 'chunk offsets'} in the track")
    head = boxes[b"mdhd"]
    if data[head[0]]:
        timescale, duration = int(_numbers(data, head, 20, 1)[0]), int(_numbers(data, head, 24, 1, 8)[0])
    else:
        timescale, duration = map(int, _numbers(data, head, 12, 2))
    each, n = map(int, _numbers(data, boxes[b"stsz"], 4, 2))
    if n > SAMPLES or each * n > len(data):
        raise ValueError("more samples than the file can hold")
    lengths = np.full(n, each, dtype=np.int64) if each else _numbers(data, boxes[b"stsz"], 12, n)
    wide = b"co64" in boxes
    chunks = _counted(data, boxes[b"co64" if wide else b"stco"], 1, 8 if wide else 4)[:, 0]
    runs = _counted(data, boxes[b"stsc"], 3)
    if len(chunks) and (not len(runs) or runs[0, 0] != 1 or (np.diff(np.append(runs[:, 0], len(chunks) + 1)) <= 0).any()):
        raise ValueError("runs of chunks are out of order")
    per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1))) if len(chunks) else np.zeros(0, np.int64)
    if per.sum() != n:
        raise ValueError("chunks and samples disagree")
    chunks, per = chunks[per > 0], per[per > 0]
    begins = np.cumsum(lengths) - lengths
    offsets = begins + np.repeat(chunks - begins[np.cumsum(per) - per], per) if n else begins
    if n and ((offsets + lengths).max() > len(data) or offsets.min() < 0):
        raise ValueError("a sample lies outside the file")
    times = _counted(data, boxes[b"stts"], 2)
    if times[:, 0].sum() != n:
        raise ValueError("times and samples disagree")
    steps = np.repeat(times[:, 1], times[:, 0])
    sync = np.arange(n)
    if b"stss" in boxes:
        sync = _counted(data, boxes[b"stss"])[:, 0] - 1
        if len(sync) and (sync.min() < 0 or sync.max() >= n or (np.diff(sync) <= 0).any()):
            raise ValueError("a sync sample that the track doesn't have")
    entry = boxes[b"stsd"]
    if not int(_numbers(data, entry, 4, 1)[0]):
        raise ValueError("no sample description")
    _numbers(data, entry, 8, 2)
    codec = data[entry[0] + 12 : entry[0] + 16].decode("latin-1")
    return {"codec": codec, "timescale": timescale, "duration": duration, "offsets": offsets, "lengths": lengths, "times": np.cumsum(steps) - steps, "sync": sync}


def sample_ranges(data: bytes) -> dict:
    """The first video track, or else the first track; each track is read from its own boxes only."""
    found = tracks(data)
    video = [t for t in found if b"hdlr" in t and data[t[b"hdlr"][0] + 8 : t[b"hdlr"][0] + 12] == b"vide"]
    return decode_track(data, (video or found)[0]) | {"n_tracks": len(found)}


def extract_payload(data: bytes) -> bytes:
    """The track's sample bytes in sample order, found through the tables alone."""
    at = sample_ranges(data)
    return b"".join(data[o : o + n] for o, n in zip(at["offsets"].tolist(), at["lengths"].tolist(), strict=True))


def _probe(data: bytes | None) -> dict:
    empty = {"status": "null", "codec": None, "timescale": None, "duration": None, "seconds": None, "n_samples": None, "sample_bytes": None, "keyframes": None, "n_tracks": None}
    if data is None:
        return empty
    try:
        at = sample_ranges(data)
    except (ValueError, struct.error, IndexError) as error:
        return empty | {"status": f"invalid: {error}"}
    return {
        "status": "ok", "codec": at["codec"], "timescale": at["timescale"], "duration": at["duration"],
        "seconds": at["duration"] / at["timescale"] if at["timescale"] else None,
        "n_samples": len(at["lengths"]), "sample_bytes": int(at["lengths"].sum()),
        "keyframes": [{"offset": o, "length": k, "time": t} for o, k, t in zip(*(at[x][at["sync"]].tolist() for x in ("offsets", "lengths", "times")), strict=True)],
        "n_tracks": at["n_tracks"],
    }


def mux(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's padded UTF-8 bytes in a container.  Null texts count as empty; repeats stay."""

    def run(rows: dict) -> dict:
        raw = [(t or "").encode() for t in rows["text"]]
        return {"id": rows["id"], "n_bytes": [len(x) for x in raw], "media": [write_container(pad(x)) for x in raw]}

    return map_batches(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id long, n_bytes long, media binary", run, "text")


def probe(df: DataFrame, keep: tuple[str, ...] = ("id",), media: str = "media", payload: bool = False) -> DataFrame:
    """Container facts for each row of the binary column ``media``, beside the long columns named in ``keep``.

    A null container has status 'null', one that is broken, has no track or keeps its samples in fragments
    'invalid: …' and nulls beside it; none fails the job.  Repeated rows stay and an empty table gives no row.  With ``payload`` the
    digests of the stored form and of the bytes read back through the sample tables are added.
    """
    more = ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string" if payload else ""

    def run(rows: dict) -> dict:
        found = [_probe(x) for x in rows["media"]]
        out = {k: rows[k] for k in keep} | {k: [x[k] for x in found] for k in found[0]}
        if payload:
            read = [extract_payload(m) if x["status"] == "ok" else None for m, x in zip(rows["media"], found, strict=True)]
            out["payload_bytes"] = [None if x is None else len(x) for x in read]
            out["payload_sha256"] = [None if x is None else hashlib.sha256(x).hexdigest() for x in read]
            out["tail_crc32"] = [None if x is None else zlib.crc32(x[-ROW:]) for x in read]
            out["media_bytes"] = [None if m is None else len(m) for m in rows["media"]]
            out["media_sha256"] = [None if m is None else hashlib.sha256(m).hexdigest() for m in rows["media"]]
        return out

    return map_batches(df.select(*(F.col(k).cast("long").alias(k) for k in keep), F.col(media).alias("media")), ", ".join(f"{k} long" for k in keep) + ", " + PROBED + more, run, "media")
