"""TIFF as a media column: reading pages, and a writer for storing payloads as images.

The reader walks the chain of image directories (either byte order, 32-bit offsets), decodes strips or tiles stored plain,
as PackBits, LZW or deflate, undoes the horizontal predictor and emits one row per page. It reads 8-bit samples of any
number per pixel, in chunky layout. What it can't read makes a row with an error, not an exception: counts, offsets and sizes
are checked against the bytes that are there, and a page's pixels get memory as its strips or tiles are decoded, so a header
can't ask for more than ``EXPAND`` times the bytes of its file (more than deflate or LZW can pack).

Defined cases: null media give no row; bytes that are no TIFF give one row with an error and page null; a directory that
links back to an earlier one ends the walk; a page that can't be read keeps its number, and the pages after it are read;
extra columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
#: Tags of the format that are read or written.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, PLANES = 322, 323, 324, 325, 284
_TYPES = {1: "B", 3: "H", 4: "I"}
UNIT = 576
PAGE_ROWS = 64
EXPAND = 1500


class BadTiff(ValueError):
    pass


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < size:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2 if n > 128 else 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more bytes as repeats, the rest as literals."""
    out, at, literal = bytearray(), 0, 0

    def flush(end: int) -> None:
        for s in range(literal, end, 128):
            part = data[s : min(end, s + 128)]
            out.append(len(part) - 1)
            out.extend(part)

    while at < len(data):
        run = at + 1
        while run < len(data) and run - at < 128 and data[run] == data[at]:
            run += 1
        if run - at >= 3:
            flush(at)
            out.append(257 - (run - at))
            out.append(data[at])
            literal = run
        at = run
    flush(len(data))
    return bytes(out)


def unpack_lzw(data: bytes, size: int) -> bytes:
    """Codes of 9 to 12 bits, high bit first; a width grows one code early, as TIFF has it."""
    singles = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, last = list(singles), bytearray(), b""
    hold = have = at = 0
    width = 9
    while len(out) < size:
        while have < width and at < len(data):
            hold, have, at = (hold << 8 | data[at]) & 0xFFFFFF, have + 8, at + 1
        if have < width:
            break
        code = hold >> (have - width) & ((1 << width) - 1)
        have -= width
        if code == 257:
            break
        if code == 256:
            table, width, last = list(singles), 9, b""
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and last:
            entry = last + last[:1]
        else:
            raise BadTiff(f"LZW code {code} of {len(table)}")
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def pack_lzw(data: bytes) -> bytes:
    out, hold, have = bytearray(), 0, 0
    table, width, current = {bytes([i]): i for i in range(256)}, 9, b""
    following = 258

    def put(code: int) -> None:
        nonlocal hold, have
        hold, have = hold << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(hold >> have & 255)
        hold &= (1 << have) - 1

    put(256)
    for i in range(len(data)):
        grown = current + data[i : i + 1]
        if grown in table:
            current = grown
            continue
        put(table[current])
        table[grown], following, current = following, following + 1, data[i : i + 1]
        if following == 4094:
            put(256)
            table, width, following = {bytes([k]): k for k in range(256)}, 9, 258
        else:
            width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    if current:
        put(table[current])
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if have:
        out.append(hold << (8 - have) & 255)
    return bytes(out)


_PACK = {NONE: bytes, LZW: pack_lzw, DEFLATE: lambda d: zlib.compress(d, 6), PACKBITS: pack_bits}


def _unpack(data: bytes, kind: int, size: int) -> bytes:
    if kind == NONE:
        return data
    if kind in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, size) if size else b""
        except zlib.error as e:
            raise BadTiff(f"deflate: {e}") from e
    if kind == LZW:
        return unpack_lzw(data, size)
    if kind == PACKBITS:
        return unpack_bits(data, size)
    raise BadTiff(f"compression {kind}")


def pages(media: bytes) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(width, height, samples, pixels) of each page, pixels as height x width x samples bytes."""
    for found in pages_or_errors(media):
        if isinstance(found, BadTiff):
            raise found
        yield found


def pages_or_errors(media: bytes) -> Iterator[tuple[int, int, int, np.ndarray] | BadTiff]:
    """Each page, or why it can't be read; raises where the file has no further page to go to."""
    order = {b"II": "<", b"MM": ">"}.get(media[:2])
    if order is None or len(media) < 8 or struct.unpack(order + "H", media[2:4])[0] != 42:
        raise BadTiff("no TIFF header")
    (at,) = struct.unpack(order + "I", media[4:8])
    seen: set[int] = set()
    while at and at not in seen:
        seen.add(at)
        try:
            tags, at = _directory(media, order, at)
        except struct.error as e:
            raise BadTiff("a directory lies outside the file") from e
        try:
            found = _page(media, tags)
        except BadTiff as e:
            found = e
        yield found


def _directory(media: bytes, order: str, at: int) -> tuple[dict[int, tuple[int, ...]], int]:
    (n,) = struct.unpack_from(order + "H", media, at)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", media, at + 2 + 12 * i)
        if kind not in _TYPES or not count:
            continue
        size = struct.calcsize(_TYPES[kind]) * count
        place = at + 10 + 12 * i
        if size > 4:
            (place,) = struct.unpack_from(order + "I", media, place)
        if place + size <= len(media):  # a tag whose values lie outside the file counts as missing
            tags[tag] = struct.unpack_from(f"{order}{count}{_TYPES[kind]}", media, place)
    return tags, struct.unpack_from(order + "I", media, at + 2 + 12 * n)[0]


def _page(media: bytes, tags: dict[int, tuple[int, ...]]) -> tuple[int, int, int, np.ndarray]:
    one = lambda tag, default=0: tags.get(tag, (default,))[0]
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    if not width or not height or not samples:
        raise BadTiff("no size")
    kind, predictor = one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if set(tags.get(BITS, (1,))) != {8} or one(PLANES, 1) != 1 or predictor not in (1, 2):
        raise BadTiff("only chunky 8-bit samples and the horizontal predictor are read")
    tiled = TILE_OFFSETS in tags
    if tiled:
        across, down, starts, sizes = one(TILE_WIDTH), one(TILE_HEIGHT), tags[TILE_OFFSETS], tags.get(TILE_BYTES, ())
    else:
        across, down, starts, sizes = width, min(height, one(STRIP_ROWS, height)), tags.get(STRIP_OFFSETS, ()), tags.get(STRIP_BYTES, ())
    per_row = -(-width // across) if across else 0
    if not per_row or not down or len(starts) != len(sizes) or per_row * -(-height // down) != len(starts):
        raise BadTiff("strips or tiles don't cover the page")
    if any(start + size > len(media) for start, size in zip(starts, sizes, strict=True)):
        raise BadTiff("a strip or tile lies outside the file")
    if across * down * len(starts) * samples > EXPAND * len(media):
        raise BadTiff("the size stated can't come from a file of this size")
    bands = []  # each the height of a strip or a row of tiles
    for top in range(0, height, down):
        rows = down if tiled else min(down, height - top)
        band = np.zeros((rows, per_row * across, samples), np.uint8)
        for k in range(per_row):
            i = top // down * per_row + k
            raw = _unpack(media[starts[i] : starts[i] + sizes[i]], kind, rows * across * samples)
            if len(raw) < rows * across * samples:
                raise BadTiff("a strip or tile is short")
            block = np.frombuffer(raw, np.uint8, rows * across * samples).reshape(rows, across, samples)
            if predictor == 2:
                block = np.add.accumulate(block, axis=1, dtype=np.uint8)
            band[:, k * across : (k + 1) * across] = block
        bands.append(band[: height - top, :width])
    return width, height, samples, bands[0] if len(bands) == 1 else np.concatenate(bands)


def write(images: list[np.ndarray], kind: int = DEFLATE, predictor: int = 2, strip_rows: int = PAGE_ROWS, tile: tuple[int, int] | None = None, order: str = "<") -> bytes:
    """A TIFF of grey or many-sample pages (height x width [x samples] bytes), in strips, or in tiles of (width, height)."""
    out = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8))
    link = 4
    for image in images:
        image = image.reshape(*image.shape[:2], -1)
        height, width, samples = image.shape
        if tile:
            across, down = tile
            full = np.zeros((-(-height // down) * down, -(-width // across) * across, samples), np.uint8)
            full[:height, :width] = image
            blocks = [full[y : y + down, x : x + across] for y in range(0, full.shape[0], down) for x in range(0, full.shape[1], across)]
        else:
            blocks = [image[y : y + strip_rows] for y in range(0, height, strip_rows)]
        places = []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], block[:, 1:] - block[:, :-1]], axis=1)
            data = _PACK[kind](block.tobytes())
            places.append((len(out), len(data)))
            out += data
        starts, sizes = [p[0] for p in places], [p[1] for p in places]
        tags = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8] * samples), (COMPRESSION, 3, [kind]), (PHOTOMETRIC, 3, [2 if samples == 3 else 1]), (SAMPLES, 3, [samples]), (PREDICTOR, 3, [predictor])]
        tags += [(TILE_WIDTH, 4, [tile[0]]), (TILE_HEIGHT, 4, [tile[1]]), (TILE_OFFSETS, 4, starts), (TILE_BYTES, 4, sizes)] if tile else [(STRIP_OFFSETS, 4, starts), (STRIP_ROWS, 4, [strip_rows]), (STRIP_BYTES, 4, sizes)]
        entries = bytearray()
        for tag, form, values in sorted(tags):
            data = struct.pack(f"{order}{len(values)}{_TYPES[form]}", *values)
            if len(data) > 4:
                out += b"\0" * (len(out) % 2)
                data, place = struct.pack(order + "I", len(out)), data
                out += place
            entries += struct.pack(order + "HHI", tag, form, len(values)) + data.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def read_pages(media: DataFrame, column: str = "media") -> DataFrame:
    """One row per page: the other columns, page (from 0), width, height, samples, pixels (bytes) and error."""
    own = ("page int", "width int", "height int", "samples int", "pixels binary", "error string")
    names = [o.split()[0] for o in own]
    others = [c for c in media.columns if c != column and c not in names]
    fields = [f"`{c}` {media.schema[c].dataType.simpleString()}" for c in others]

    def found_in(data: bytes) -> Iterator[tuple]:
        n = 0
        try:
            for page in pages_or_errors(data):
                yield (n, None, None, None, None, str(page)) if isinstance(page, BadTiff) else (n, *page[:3], page[3].tobytes(), None)
                n += 1
        except BadTiff as e:
            yield (n or None, None, None, None, None, str(e))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches, 64):
            row, out = [], []
            for i, data in enumerate(b.column(b.num_columns - 1).to_pylist()):
                for page in found_in(data) if data is not None else ():
                    row.append(i)
                    out.append(page)
                    if len(out) >= 64 or sum(len(p[4] or b"") for p in out) > common.SLICE_BYTES:
                        yield batch(b, row, out)
                        row, out = [], []
            if out:
                yield batch(b, row, out)

    def batch(b: pa.RecordBatch, row: list, out: list) -> pa.RecordBatch:
        kept = b.select(list(range(b.num_columns - 1))).take(pa.array(row, pa.int64()))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]], names=[*others, *names])

    return common.map_arrow(media.select(*others, column), work, ", ".join([*fields, *own]))


def payload_of(raw: bytes) -> bytes:
    """The bytes with 255s appended up to a positive multiple of UNIT."""
    return raw + b"\xff" * (UNIT * max(1, -(-len(raw) // UNIT)) - len(raw))


def encode(raw: bytes) -> bytes:
    """A payload as grey pages UNIT pixels wide and at most PAGE_ROWS high: deflated strips with the horizontal predictor."""
    rows = np.frombuffer(payload_of(raw), np.uint8).reshape(-1, UNIT)
    return write([rows[y : y + PAGE_ROWS] for y in range(0, len(rows), PAGE_ROWS)])


def encoded(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text stored as a TIFF."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([encode(r) for r in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return common.map_arrow(docs.select("doc_id", common.text_of(F.col("text")).alias("text")), work, f"doc_id {id_type}, n_bytes long, media binary")


def feature_of(images: list[np.ndarray]) -> str:
    """Size, page count, mean, spread and a 64-bit difference hash of all pages as one grey image."""
    whole = np.concatenate(images)[:, :, 0]
    rows, columns = np.linspace(0, len(whole), 9).astype(int), np.linspace(0, whole.shape[1], 10).astype(int)
    sums = np.zeros((len(whole) + 1, whole.shape[1] + 1), np.int64)
    sums[1:, 1:] = whole.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)
    top, bottom = rows[:-1], np.maximum(rows[1:], rows[:-1] + 1)
    bottom = np.minimum(bottom, len(whole))
    top = np.minimum(top, bottom - 1)
    cells = sums[bottom][:, columns[1:]] - sums[top][:, columns[1:]] - sums[bottom][:, columns[:-1]] + sums[top][:, columns[:-1]]
    cells = cells / ((bottom - top)[:, None] * (columns[1:] - columns[:-1])[None, :])
    mark = np.packbits((cells[:, 1:] > cells[:, :-1]).ravel()).tobytes().hex()
    return f"{whole.shape[1]}x{len(whole)}:{len(images)}:{int(sums[-1, -1])}:{int(np.bincount(whole.ravel(), minlength=256).max())}:{mark}"


def digests(media: DataFrame) -> DataFrame:
    """Per document what its stored bytes hold, read back page by page. media: doc_id, n_bytes, media."""
    id_type = media.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches, 128):
            out: list[list] = [[] for _ in range(6)]
            for data in b.column(2).to_pylist():
                images = [p[3] for p in pages(data)]
                payload = b"".join(i.tobytes() for i in images)
                row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(images))
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, t) for x, t in zip(out, types, strict=True)]], names=["doc_id", "n_bytes", *names])

    return common.map_arrow(media, work, f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(encoded(common.read_texts(spark, sf_dir, "documents", "doc_id", "text")))
