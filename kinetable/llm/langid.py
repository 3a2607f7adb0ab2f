"""Language identification by compression with one zstandard dictionary per language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_by_value

ship_by_value(__name__)

MAX_LANGS = 500  # a model is refused beyond it, which bounds what travels to the tasks
_OTHER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Raw-content dictionaries by language, each of at most ``dict_bytes``."""

    dictionaries: dict[str, bytes]


def letters(text: str) -> str:
    """Lower-case words of letters with one space between them."""
    return _OTHER.sub(" ", text.lower()).strip()


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    docs_per_lang: int = 400, chars_per_doc: int = 1500, dict_bytes: int = 1 << 17,
) -> Model:
    """Dictionaries from a bounded sample: the first ``docs_per_lang`` documents of each language by a hash of
    ``key``, ``chars_per_doc`` characters of each. Rows without text or language are not learned from;
    no such row gives a model without languages. If the sample of a language is larger than ``dict_bytes``, every
    document gives an equal share of them, shorter ones all they have. More than ``MAX_LANGS`` languages are refused.
    """
    known = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    rows = known.select(F.col(key).alias("k"), F.col(lang).alias("l"))
    order = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")
    picked = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_lang).select("k", "l").distinct()
    picked = picked.limit((MAX_LANGS + 1) * docs_per_lang)
    cut = known.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.substring(text, 1, chars_per_doc).alias("t"))
    found = cut.join(F.broadcast(picked), ["k", "l"]).groupBy("l", "t").agg(F.min(F.xxhash64("k")).alias("h")).collect()
    by_lang: dict[str, list[bytes]] = {}
    for row in sorted(found, key=lambda r: (r.h, r.t)):  # as picked, not by the alphabet
        if part := letters(row.t).encode():
            by_lang.setdefault(row.l, []).append(part)
    if len(by_lang) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    return Model({name: shared_out(parts, dict_bytes) for name, parts in sorted(by_lang.items())})


def shared_out(parts: list[bytes], most: int) -> bytes:
    """``parts`` joined to at most ``most`` bytes; each has an equal share, and what short ones leave is the others'."""
    left, share = most - len(parts) + 1, 0
    for i, n in enumerate(sorted(map(len, parts))):
        share = max(0, left) // (len(parts) - i)
        if n > share:
            break
        left, share = left - n, n
    whole = [p[:share].decode(errors="ignore").encode() for p in parts]
    return b" ".join(whole)[:most]


def _encoders(dictionaries: dict[str, bytes], level: int) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for name, raw in dictionaries.items():
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        made.append((name, zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)))
    return made


def judge(text: str | None, encoders: list, plain: zstandard.ZstdCompressor, piece: int, lead: float) -> tuple[str | None, float]:
    """The language whose dictionary encodes the whole text smallest, and its margin: 1 - smallest / second.

    None for a text that is null or has no letter. Within a piece no size counts as more than ``lead``
    times the smallest, so that one passage that a dictionary happens to hold doesn't decide for a long
    text. With one language the second is the encoding without dictionary. Equal sizes go to the
    smaller name.
    """
    clean = letters(text) if text else ""
    if not encoders or not any(map(str.isalpha, clean)):
        return None, 0.0
    raw = clean.encode()
    coders = [e for _, e in encoders]
    if len(coders) == 1:
        coders.append(plain)
    totals = [0.0] * len(coders)
    for i in range(0, len(raw), piece):
        part = raw[i : i + piece]
        sizes = [len(e.compress(part)) for e in coders]
        most = lead * min(sizes)
        totals = [t + min(s, most) for t, s in zip(totals, sizes, strict=True)]
    if len(encoders) == 1:
        return encoders[0][0], max(0.0, 1.0 - totals[0] / totals[1])
    (first, name), (second, _) = sorted(zip(totals, (n for n, _ in encoders), strict=True))[:2]
    return name, max(0.0, 1.0 - first / second)


def identify(
    docs: DataFrame, model: Model, text: str = "text", min_margin: float = 0.002, level: int = 3,
    piece: int = 512, lead: float = 1.2,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the margin, 0 to 1) and ``rejected``.

    Whole texts are encoded in pieces of ``piece`` bytes, so a long text is not judged by its own
    repetitions. ``rejected``: no letter (``lang_pred`` is then ``und``), no learned language, or a margin below
    ``min_margin``. Columns of these names are replaced.
    """
    dictionaries = model.dictionaries

    @F.pandas_udf("lang string, margin double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(dictionaries, level)
        plain = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        for texts in batches:
            yield pd.DataFrame([judge(t, encoders, plain, piece, lead) for t in texts], columns=["lang", "margin"])

    seen = docs.drop("lang_pred", "score", "rejected").withColumn("_judged", judged(F.col(text)))
    return seen.withColumns({
        "lang_pred": F.coalesce("_judged.lang", F.lit("und")),
        "score": F.col("_judged.margin"),
        "rejected": F.col("_judged.lang").isNull() | (F.col("_judged.margin") < min_margin),
    }).drop("_judged")


def held_out(key: str = "doc_id"):
    """Rows kept for measuring: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))
