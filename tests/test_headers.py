import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimloom.sources import captured
from claimloom.sources.headers import image_size


def box(kind, body, size=None):
    return struct.pack(">I", len(body) + 8 if size is None else size) + kind + body


def ispe(w, h):
    return box(b"ispe", struct.pack(">III", 0, w, h))


def avif(*sizes, primary=1, of={1: [1]}, wide=False, brand=b"avif", long=False):
    width = ">H" if wide else ">B"
    rows = b"".join(struct.pack(">HB", item, len(places)) + b"".join(struct.pack(width, p | (0x8000 if wide else 0x80)) for p in places) for item, places in of.items())
    ipma = box(b"ipma", struct.pack(">II", int(wide), len(of)) + rows)
    pitm = box(b"pitm", struct.pack(">IH", 0, primary)) if primary else b""
    inner = b"\0\0\0\0" + box(b"hdlr", b"\0" * 8) + pitm + box(b"iprp", box(b"ipco", b"".join(ispe(*s) for s in sizes)) + ipma)
    meta = struct.pack(">I", 1) + b"meta" + struct.pack(">Q", len(inner) + 16) + inner if long else box(b"meta", inner)
    return box(b"ftyp", b"mif1\0\0\0\0" + brand) + meta + box(b"mdat", b"\xff" * 9, 0)


def webp(kind, body):
    return b"RIFF\0\0\0\0WEBP" + kind + struct.pack("<I", len(body)) + body


FRAME = b"\xff\xc2\0\x11\x08" + struct.pack(">HH", 30, 40)
IMAGES = {
    "png": b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 40, 30),
    "gif": b"GIF89a" + struct.pack("<HH", 40, 30),
    "jpeg": b"\xff\xd8\xff\xe0\0\x04ab\xff\xff\x01\xff\xd0\xff\xc4\0\x03x" + FRAME,
    "webp extended": webp(b"VP8X", b"\0" * 4 + (39).to_bytes(3, "little") + (29).to_bytes(3, "little")),
    "webp lossy": webp(b"VP8 ", b"\x10\0\0\x9d\x01\x2a" + struct.pack("<HH", 40 | 0x4000, 30 | 0x8000)),
    "webp lossless": webp(b"VP8L", b"\x2f" + (39 | 29 << 14 | 1 << 28).to_bytes(4, "little")),
    "avif": avif((40, 30)),
    "avif thumbnail first": avif((8, 6), (40, 30), of={1: [2], 2: [1]}),
    "avif wide, primary 2": avif((800, 600), (40, 30), primary=2, of={1: [1], 2: [2]}, wide=True),
    "avif no primary": avif((8, 6), (40, 30), primary=None),
    "avif sequence, long box": avif((40, 30), brand=b"avis", long=True),
}


@pytest.mark.parametrize("name", IMAGES)
def test_sizes_and_every_way_to_cut_them_off(name):
    whole = IMAGES[name]
    want = {"format": name.split()[0], "width": 40, "height": 30}
    assert image_size(whole) == want and image_size(whole + b"rest" * 50 if "avif" not in name else whole) == want
    for n in range(len(whole)):
        assert image_size(whole[:n]) in (want, {**want, "width": None, "height": None}, {"format": None, "width": None, "height": None})


def test_odd_headers():
    none = {"format": None, "width": None, "height": None}
    assert image_size(None) == image_size(b"") == image_size(b"BM1234") == image_size(box(b"ftyp", b"mp42\0\0\0\0isom")) == none
    assert image_size(webp(b"VP8 ", b"\x11\0\0\x9d\x01\x2a" + b"\1" * 4))["width"] is None  # no key frame
    assert image_size(IMAGES["png"][:16] + b"\0" * 8)["width"] is None  # no extent
    assert image_size(b"\xff\xd8\xff\xe0\0\0" * 4) == {"format": "jpeg", "width": None, "height": None}  # a length that does not move on
    assert image_size(box(b"ftyp", b"avif\0\0\0\0") + box(b"meta", b"\0\0\0\0" + box(b"iprp", ispe(1, 1), 9)))["width"] is None  # an inner box longer than its outer one


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(sorted(IMAGES)), st.lists(st.tuples(st.integers(0, 200), st.integers(0, 255)), max_size=12))
def test_damaged_headers_are_no_errors(name, changes):
    data = bytearray(IMAGES[name])
    for at, byte in changes:
        data[at % len(data)] = byte
    found = image_size(bytes(data))
    assert (found["width"] is None) == (found["height"] is None)


def test_files_of_all_kinds(spark, tmp_path):
    for k, (name, data) in enumerate(sorted(IMAGES.items())):
        (tmp_path / f"{k}.bin").write_bytes(data)
    (tmp_path / "99.bin").write_bytes(b"nothing")
    rows = captured.read_images(spark, str(tmp_path)).collect()
    assert sorted(r.format or "" for r in rows) == sorted([n.split()[0] for n in IMAGES] + [""])
    assert {(r.width, r.height) for r in rows if r.format} == {(40, 30)} and {r.width for r in rows if not r.format} == {None}
