"""Secret scan: fixed patterns, and novelty under a dictionary-primed zstandard compressor.

Base spans come from three patterns. Beyond them, tokens that stand within ``REACH`` characters after
a sensitive word are candidates. A candidate's novelty is the number of compressed bytes it adds:
the text around it is compressed with and without it, by a compressor primed with an identifier
dictionary. Identifiers, words and repeated values cost little; a candidate that adds at least
``NOVELTY`` bytes for each of its own is reported as kind ``novel``.

The dictionary holds the identifiers seen most often near sensitive words in all documents, counted
by document, up to ``DICTIONARY_BYTES``; letters and underscores only, so that no secret gets in.

Defined cases: a null or empty text has no spans; a document that occurs twice is scanned twice;
candidates that overlap a base span are not reported again; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.textbytes import map_texts, sliced, text_of

KINDS = ("assign", "access", "hex", "novel")
REACH = 40
AROUND = 256
SHORTEST = 16
#: Compressed bytes that each byte of a candidate adds, at least.
NOVELTY = 0.6
DICTIONARY_BYTES = 32_768

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SENSITIVE = (*KEYWORDS, "api-key", "credential", "private", "auth", "bearer", "access_key", "-----begin")
CONTEXT = re.compile("|".join(map(re.escape, SENSITIVE)))
#: ``=`` begins a value, unless it pads the end of one.
VALUE = "[A-Za-z0-9+/_~.-]"
PADDING = rf"(?:={{1,2}}(?!{VALUE}|=))"
CANDIDATE = re.compile(
    rf"(?<!{VALUE})(?:{VALUE}{{{SHORTEST},}}+{PADDING}?|{VALUE}{{{SHORTEST - 1}}}{PADDING}"
    rf"|{VALUE}{{{SHORTEST - 2}}}==(?!{VALUE}|=))"
)
IDENTIFIER = re.compile(r"[A-Za-z_]{3,40}")


def ascii_lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


def base_spans(text: str, low: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by the fixed patterns."""
    spans = []
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def contexts(low: str) -> list[tuple[int, int]]:
    """Merged ranges that follow a sensitive word, the word included."""
    merged: list[tuple[int, int]] = []
    if not any(k in low for k in SENSITIVE):
        return merged
    for m in CONTEXT.finditer(low):
        a, b = m.start(), m.end() + REACH
        if merged and a <= merged[-1][1]:
            a = merged.pop()[0]
        merged.append((a, b))
    return merged


def candidates(text: str, low: str) -> Iterator[tuple[int, int]]:
    """Tokens that begin in a sensitive context."""
    end = 0
    for a, b in contexts(low):
        at = max(a, end)
        while (m := CANDIDATE.search(text, at)) and m.start() <= b:
            yield m.start(), m.end()
            at = end = m.end()


class Novelty:
    """Marginal compressed bytes under a primed compressor."""

    def __init__(self, dictionary: bytes) -> None:
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.tool = zstandard.ZstdCompressor(level=9, dict_data=primed if dictionary else None)

    def added(self, before: str, token: str, after: str) -> int:
        with_it, without = (
            len(self.tool.compress((before + x + after).encode("utf-8", "replace"))) for x in (token, "")
        )
        return with_it - without

    def spans(self, text: str, low: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
        found = []
        for a, b in candidates(text, low):
            if any(s < b and a < e for s, _, e in base):
                continue
            # Surroundings first, so that they prime the compressor for the candidate.
            around = text[max(0, a - AROUND) : a], text[b : b + AROUND]
            if self.added(around[0] + around[1] + "\n", text[a:b], "") >= NOVELTY * (b - a):
                found.append((a, "novel", b))
        return found


def identifier_dictionary(docs: DataFrame, text_col: str = "text") -> bytes:
    """Identifiers near sensitive words, the most frequent last, where zstandard looks first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()
        for batch in sliced(batches, "text"):
            for text in text_of(batch, "text").to_pylist():
                low = ascii_lower(text or "")
                near = (text[max(0, a - REACH) : b] for a, b in contexts(low)) if low else ()
                count.update({w for part in near for w in IDENTIFIER.findall(part)})
            if len(count) > 100_000:
                yield table(count)
                count.clear()
        yield table(count)

    def table(count: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "n"]
        )

    seen = map_texts(docs.select(F.col(text_col).alias("text")), work, "word string, n long")
    most = seen.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    most = most.orderBy(F.desc("n"), "word").limit(DICTIONARY_BYTES // 4).collect()
    words = [*SENSITIVE, *(r["word"] for r in most)]
    kept, size = [], 0
    for w in words:
        size += len(w) + 1
        if size > DICTIONARY_BYTES:
            break
        kept.append(w)
    return " ".join(reversed(kept)).encode()


def scan(docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id and ``found``, spans (kind, start, end) in code points, by start."""
    own = docs.select(id_col, text_col)
    id_name, name = own.columns
    span = T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType())
    schema = T.StructType([own.schema[0]]).add("found", T.ArrayType(span))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in sliced(batches, name):
            found = []
            for text in text_of(batch, name).to_pylist():
                text = text or ""
                low = ascii_lower(text)
                base = base_spans(text, low)
                every = sorted(base + novelty.spans(text, low, base), key=lambda s: (s[0], KINDS.index(s[1])))
                found.append([{"kind": k, "start": a, "end": b} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[id_name, "found"])

    return map_texts(own, work, schema)
