"""Media columns: round trips, tables of each track, and broken containers that fail no job."""

import hashlib
import struct
import zlib

import numpy as np
import pytest

from tapelake.llm import media
from tests.llm.test_operators import HARD, SCHEMA


def test_round_trip(spark):
    hard, empty = spark.createDataFrame([(i, t, "clash", "clash", "clash", 0, "clash") for i, t in HARD], SCHEMA), spark.createDataFrame([], SCHEMA)
    got = media.probe(media.mux(hard), keep=("id", "n_bytes"), payload=True).collect()
    assert len(got) == len(HARD)
    texts = {i: t or "" for i, t in HARD}
    for r in got:
        raw = media.pad(texts[r["id"]].encode())
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]))
        assert r["sample_bytes"] == len(raw) and r["codec"] == "raw "
    assert media.mux(empty).count() == 0
    bad = hard.sparkSession.createDataFrame([(1, None), (2, b"junk"), (3, struct.pack(">I", 99) + b"moov")], "id long, media binary")
    assert [r["status"].split(":")[0] for r in media.probe(bad).orderBy("id").collect()] == ["null", "invalid", "invalid"]


def moved(data: bytes, by: int) -> bytes:
    """The container with every chunk offset of 32 bits moved."""
    at = data.index(b"stco") + 8
    count = struct.unpack_from(">I", data, at)[0]
    offsets = np.frombuffer(data, ">u4", count, at + 4) + by
    return data[: at + 4] + offsets.astype(">u4").tobytes() + data[at + 4 + 4 * count :]


def patched(data: bytes, kind: bytes, at: int, *values: int) -> bytes:
    start = data.index(kind) + 4 + at
    return data[:start] + struct.pack(f">{len(values)}I", *values) + data[start + 4 * len(values) :]


GOOD = media.write_container(media.pad(bytes(range(256)) * 600))


def test_keyframes_have_times():
    found = media.sample_ranges(GOOD)
    assert found["times"].tolist() == list(range(len(found["lengths"]))) and found["n_tracks"] == 1
    slower = patched(GOOD, b"stts", 8, len(found["lengths"]), 7)
    probed = media._probe(slower)
    assert [k["time"] for k in probed["keyframes"]] == [7 * 16 * i for i in range(len(probed["keyframes"]))]
    assert b"".join(slower[k["offset"] : k["offset"] + 4] for k in probed["keyframes"]) == bytes(range(4)) * len(probed["keyframes"])


def test_each_track_is_read_by_itself():
    """A first track without stss has only sync samples; the second's table isn't its own."""
    at = GOOD.index(b"moov") - 4
    track = GOOD[GOOD.index(b"trak") - 4 :]
    size = struct.unpack_from(">I", GOOD, GOOD.index(b"stss") - 4)[0]
    bare = GOOD.replace(GOOD[GOOD.index(b"stss") - 4 : GOOD.index(b"stss") - 4 + size], b"")
    for kind in (b"moov", b"trak", b"mdia", b"minf", b"stbl"):
        here = bare.index(kind) - 4
        bare = bare[:here] + struct.pack(">I", struct.unpack_from(">I", bare, here)[0] - size) + bare[here + 4 :]
    here = bare.index(b"moov") - 4
    both = bare[:here] + struct.pack(">I", struct.unpack_from(">I", bare, here)[0] + len(track)) + bare[here + 4 :] + track
    found = media._probe(both)
    assert (found["status"], found["n_tracks"], len(found["keyframes"])) == ("ok", 2, found["n_samples"])
    sound = both.replace(b"vide", b"soun", 1)
    assert len(media._probe(sound)["keyframes"]) == len(media._probe(GOOD)["keyframes"])
    assert at == here


def nested(n: int) -> bytes:
    return b"".join(struct.pack(">I", 8 * (n - i)) + b"moov" for i in range(n))


@pytest.mark.parametrize(
    "data",
    [
        b"", b"junk", struct.pack(">I", 99) + b"moov", nested(3000), nested(3), b"\0\0\0\x08moof" + GOOD, GOOD[:-9], GOOD[:200],
        patched(GOOD, b"stss", 8, 0), patched(GOOD, b"stss", 8, 1 << 30), patched(GOOD, b"stss", 4, 1 << 30), patched(GOOD, b"stts", 8, 5),
        patched(GOOD, b"stsz", 4, 0, (1 << 32) - 1), patched(GOOD, b"stsz", 4, 1, (1 << 32) - 1), patched(GOOD, b"stsc", 8, 9), patched(GOOD, b"stsc", 4, 0),
        patched(GOOD, b"stsd", 4, 0), patched(GOOD, b"stco", 8, 1 << 31), GOOD.replace(b"stsz", b"free"), GOOD.replace(b"trak", b"free"), GOOD.replace(b"mdhd", b"free"),
    ],
)
def test_broken_containers_give_a_status(data):
    found = media._probe(data)
    assert found["status"].startswith("invalid: ") and found["keyframes"] is None


def test_any_damage_gives_a_status():
    rng = np.random.default_rng(3)
    head = GOOD.index(b"moov") - 4
    for _ in range(3000):
        data = bytearray(GOOD)
        for at in rng.integers(head, len(data), int(rng.integers(1, 4))):
            data[at] = int(rng.choice([0, 1, 255, int(rng.integers(256))]))
        assert media._probe(bytes(data))["status"].split(":")[0] in ("ok", "invalid")


def test_offsets_are_followed():
    shifted = GOOD[:8] + bytes(0) + GOOD[8:]
    assert media.extract_payload(moved(shifted, 0)) == media.extract_payload(GOOD)
    assert media.extract_payload(moved(GOOD, 1))[:-1] == media.extract_payload(GOOD)[1:]
