"""Language identification by compression.

For each language a raw-content zstandard dictionary of bounded size is gathered from training texts. A
text is compressed with each dictionary, in pieces so that the dictionary stays near, and takes the
language whose total is smallest. The score is how much smaller it is than the second; answers with a
narrow margin are marked as not accepted.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every text where
there is nothing to learn from; equal sizes go to the language that sorts first; texts of any length are
compressed whole; repeated rows get equal results; a null id is not held out, and its text is learned from; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import texts
from spanloom.llm.shared import crc_remainder

#: A dictionary is made of at most SLOTS excerpts of EXCERPT characters.
SLOTS = 512
EXCERPT = 160
PIECE = 16 << 10
NARROW = 0.01
UNKNOWN = "und"
#: Matches of four bytes tell languages apart better than the longer ones of the usual levels.
PARAMETERS = {"strategy": zstandard.STRATEGY_GREEDY, "min_match": 4, "window_log": 17, "hash_log": 16, "chain_log": 16, "search_log": 3}
_latin = re.compile("[A-Za-z]")
_plain = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str) -> bool:
    return bool(_latin.search(text)) or any(map(str.isalpha, text))


def normalised(text: str) -> bytes:
    """Lower case, with one space for each run of ASCII characters that are not letters."""
    return b" ".join(text.lower().encode().translate(_plain).split())


def learn(rows: DataFrame, slots: int = SLOTS) -> dict[str, bytes]:
    """The raw dictionary of each language from ``rows`` (text, lang).

    Texts are dealt by hash into ``slots`` slots per language; of each the text with the lowest hash is
    taken, and of that an excerpt from a place that the hash gives, so at most ``slots`` short excerpts per
    language reach the driver. Minima are combined before they are shuffled.
    """
    rows = rows.where("lang is not null and text is not null and text <> ''")
    hashed = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    least = hashed.groupBy("lang", F.pmod("h", F.lit(slots)).alias("slot")).agg(F.min("h").alias("h"))
    taken = hashed.join(F.broadcast(least.select("lang", "h")), ["lang", "h"])
    room = F.greatest(F.length("text") - EXCERPT, F.lit(1))
    excerpt = F.substring("text", (1 + F.pmod("h", room)).cast("int"), F.lit(EXCERPT))
    picked = taken.groupBy("lang", "h").agg(F.min(excerpt).alias("text")).collect()
    found: dict[str, list] = {}
    for row in sorted(picked, key=lambda r: (r.lang, r.h)):
        found.setdefault(row.lang, []).append(normalised(row.text))
    return {lang: b" ".join(excerpts) for lang, excerpts in found.items()}


def _identify_batches(batches, dictionaries):
    known = sorted(dictionaries.value)
    coders = []
    how = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **PARAMETERS)
    for lang in known:
        content = zstandard.ZstdCompressionDict(dictionaries.value[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=how)
        coders.append(zstandard.ZstdCompressor(dict_data=content, compression_params=how))
    for batch in batches:
        for part in texts.slices(batch):
            lang, score, accepted = [], [], []
            for text in part.column("text").to_pylist():
                if not known or text is None or not has_letter(text):
                    lang.append(UNKNOWN), score.append(0.0), accepted.append(False)
                    continue
                raw = normalised(text)
                pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
                size = [sum(len(c.compress(p)) for p in pieces) for c in coders]
                best = min(range(len(known)), key=size.__getitem__)
                rest = min((s for i, s in enumerate(size) if i != best), default=2 * size[best])
                margin = (rest - size[best]) / rest
                lang.append(known[best]), score.append(margin), accepted.append(margin >= NARROW)
            out = [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang_pred", "score", "accepted"])


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of the whole texts; the dictionaries' size is bounded by ``learn``."""
    shipped = docs.sparkSession.sparkContext.broadcast(dictionaries)
    return docs.select("doc_id", "text").mapInArrow(
        partial(_identify_batches, dictionaries=shipped), "doc_id long, lang_pred string, score double, accepted boolean"
    )


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted), learned from the documents that are not held out."""
    held_out = F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.where(~held_out).select("text", "lang"))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
