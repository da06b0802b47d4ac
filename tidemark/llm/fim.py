"""Fill-in-the-middle: a text is cut at two of its token boundaries and written as prefix, suffix and middle.

Boundaries are found on whole texts at once, as bits of integers.  ``bytes.translate`` turns a text's UTF-8 bytes into one digit each,
which ``int`` reads as a mask: one of the bytes that are not white space, one of those that begin a code point.  Shifted and combined,
the first has a bit where a token ends; ``bit_count`` gives how many there are, and the place of the r-th is found by halving the integer,
each time keeping the half that holds it, so the work is linear in the text's length.

Cases: a null text is empty; an empty text, and one that holds a mark, is plain; a null id is written as an empty number; repeated rows
are cut alike; texts of any length are cut whole; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectext as vt

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Digit of each byte: 1 if it is not white space; 1 if it begins a code point.
WORD = bytes(0x30 + (b not in SPACES) for b in range(256))
LEAD = bytes(0x30 + (b & 0xC0 != 0x80) for b in range(256))


def mask(text: bytes, digits: bytes) -> int:
    """Bit i is the digit of byte i."""
    return int(text.translate(digits)[::-1], 2) if text else 0


def token_ends(text: bytes) -> int:
    """Bit i is set where byte i is a token's last: the end of a word with the white space before it, or of white space at the text's end."""
    words = mask(text, WORD)
    ends = words & ~(words >> 1)
    return ends | 1 << len(text) - 1 if text else 0


def place_of(bits: int, rank: int) -> int:
    """Where the rank-th set bit stands, from 1 on; ``rank`` is at most ``bits.bit_count()``."""
    at, width = 0, bits.bit_length()
    while width > 1:
        half = width // 2
        low = bits & (1 << half) - 1
        n = low.bit_count()
        if rank <= n:
            bits, width = low, half
        else:
            bits, width, rank, at = bits >> half, width - half, rank - n, at + half
    return at


def cut_points(text: bytes, a: int, b: int) -> tuple[int, int, int]:
    """Number of tokens n, and the bytes after the smaller and the larger of a % (n+1) and b % (n+1) tokens."""
    ends = token_ends(text)
    n = ends.bit_count()
    low, high = sorted((a % (n + 1), b % (n + 1)))
    return n, *(place_of(ends, r) + 1 if r else 0 for r in (low, high))


def _arranged(most: int):
    """(doc_id, text, h1, h2, form or null) batches to rows; runs of ``most`` bytes of text are written at once."""

    @vt.lean
    def run(batches):
        for batch in batches:
            for part in vt.pieces(batch, most=most):
                out = []
                for i, text, a, b, form in zip(*(part.column(k).to_pylist() for k in range(5)), strict=True):
                    n, x, y = cut_points(text, a, b)
                    if form == "plain":
                        out.append((i, n, form, None, None, text))
                        continue
                    starts = mask(text, LEAD)
                    before = (starts & (1 << x) - 1).bit_count()
                    within = (starts & (1 << y) - 1).bit_count() - before
                    first, second = (text[:x], text[y:]) if form == "psm" else (text[y:], text[:x])
                    marks = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
                    out.append((i, n, form, before, within, b"".join((marks[0].encode(), first, marks[1].encode(), second, MIDDLE.encode(), text[x:y]))))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_binary())
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, k) if k != pa.large_binary() else pa.array(c, k).cast(pa.binary()) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def drawn(doc_id: Column, k: int, seed: int) -> Column:
    """The k-th (from 0) number of 32 bits that belongs to a document: a group of eight digits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(digest.substr(8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 42, share: int = 50, spm_share: int = 80, most: int = 2 << 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): ``share`` percent of the texts are cut, ``spm_share`` percent of these with the suffix first."""
    text, i = F.coalesce("text", F.lit("")), F.col("doc_id")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (drawn(i, 2, seed) % 100 >= share)
    form = F.when(plain, "plain").when(drawn(i, 3, seed) % 100 < spm_share, "spm").otherwise("psm")
    rows = docs.select(i.cast("long").alias("doc_id"), text.cast("binary").alias("text"), drawn(i, 0, seed).alias("h1"), drawn(i, 1, seed).alias("h2"), form.alias("form"))
    out = rows.mapInArrow(_arranged(most), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: no text that is cut holds a mark, so the marks part it."""
    part = F.split(output, "<[PSM]>", -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
f AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
p AS (SELECT *, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1:b], '') AS y, array_to_string(u[b + 1:], '') AS z FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
