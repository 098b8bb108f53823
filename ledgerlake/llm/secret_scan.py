"""Secret scan by token efficiency (operator 7).

Random strings cost a public tokenizer many tokens: its vocabulary holds the
pieces of words, not of keys.  The scan takes the base patterns (assignments,
access keys, long hex runs) and every other run of ``min_length`` or more
credential characters, encodes each run with a tiktoken vocabulary and reports
runs with fewer than ``max_ratio`` characters a token.  Runs that read like words, of
one case with vowels and consonants in turn, need fewer than ``word_ratio``: long words
of many languages are rarer in a vocabulary than short ones, and few random strings
read so.  Known digests (hex of digest lengths under a digest label, ``sha256-``
integrity values), UUIDs, time stamps and runs without a letter (numbers, which all
tokenise alike) are excluded from this added part only; base spans always stay.  Names
and paths are encoded like any run: their words keep them above the ratio.

Any style was allowed; this is ``mapInArrow``: regular expressions find spans
in whole texts, and only candidate runs are encoded.  No shuffle, no state, so
a hot source or a lost executor costs nothing but its own rows.  Memory is one
Arrow batch.

Defined results: null or empty text has no span; equal spans of two kinds are
both listed; ties sort by kind as listed; repeated rows are scanned each on
their own; an empty table gives no rows; texts of any length are scanned whole; other
columns pass through by position, and one that has a result column's name (prefix
included, in any case) raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the contract.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Runs that may be credentials; a look-behind keeps a run whole.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
STAMP = re.compile(r"\d{4}-?\d\d-?\d\d[T_-]?\d\d([-_]?\d\d){1,2}(-?\d{3,9})?Z?")
LETTER = re.compile("[A-Za-z]")
PART = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+")
CONSONANTS = re.compile("[^aeiouy]{5}")
VOWELS = re.compile("[aeiouy]")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
INTEGRITY = re.compile(r"sha(256-[A-Za-z0-9+/]{43}=|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86}==)")
DIGEST_LABEL = re.compile(r"(md5|sha-?\d{1,3}|digest|checksum|commit|etag|integrity)\W{0,4}$", re.I)

def encoder(path: str, pattern: str):
    """The tiktoken vocabulary at ``path``; a task loads it and lets it go."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def candidates(text: str, min_length: int) -> Iterator[tuple[int, int, str]]:
    """Runs of ``min_length`` or more, what stands around a UUID apart: (start, end, run)."""
    for m in RUN.finditer(text):
        at = m.start()
        for u in [*UUID.finditer(text, m.start(), m.end()), None]:
            end = u.start() if u else m.end()
            if end - at >= min_length:
                yield at, end, text[at:end]
            at = u.end() if u else end


def ratio(run: str, enc) -> float:
    """Characters a token.  Names in capitals (``MAX_SIZE``) are judged in small letters."""
    if run.upper() == run and not run.isalnum():
        run = run.lower()
    return len(run) / len(enc.encode_ordinary(run))


def like_words(run: str) -> bool:
    """Whether all parts between separators are letters of one case (or capitalised) that
    could be spoken: near a third of vowels and no five consonants in a row."""
    parts = re.split("[-_/]", run)
    if not all(PART.fullmatch(p) for p in parts if p):
        return False
    plain = "".join(parts).lower()
    return 10 * len(VOWELS.findall(plain)) >= 3 * len(plain) and not any(
        CONSONANTS.search(p.lower()) for p in parts)


def known_digest(text: str, start: int, run: str) -> bool:
    return INTEGRITY.fullmatch(run) is not None or (
            len(run) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-fA-F]+", run) is not None
            and DIGEST_LABEL.search(text, max(0, start - 24), start) is not None)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's patterns, in code points."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def random_spans(text: str, taken: list[tuple[int, int, int]], enc, max_ratio: float,
                 min_length: int, word_ratio: float | None = None) -> list[tuple[int, int, int]]:
    """Runs that tokenise badly and overlap no base span."""
    out = []
    for start, end, run in candidates(text, min_length):
        if LETTER.search(run) is None or STAMP.fullmatch(run) or known_digest(text, start, run):
            continue
        if any(a < end and start < b for a, _, b in taken):
            continue
        r = ratio(run, enc)
        if r < max_ratio and (word_ratio is None or r < word_ratio or not like_words(run)):
            out.append((start, 3, end))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def mask(text: str, spans: list[tuple[int, int, int]], by: str) -> str:
    """The text with every span, overlaps merged, replaced by ``by``."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], by]
        at = max(at, b)
    return "".join(out) + text[at:]


FOUND = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("n_random", T.LongType()),
    T.StructField("base_spans", T.StringType()), T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("masked_text", T.StringType())])


def secret_scan(df: DataFrame, vocabulary: str, pattern: str, text: str = "text",
                prefix: str = "ss_", max_ratio: float = 2.2, word_ratio: float = 1.9, min_length: int = 16,
                masked: bool = True, by: str = "[SECRET]") -> DataFrame:
    """Every row with its span counts, spans and, if wanted, the masked text.

    ``vocabulary`` and ``pattern`` are a tiktoken rank file and its split
    pattern.  Without ``masked`` the masked text is null and is not computed.
    """
    names = [prefix + f.name for f in FOUND]
    clash = {n.lower() for n in names} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist; choose another prefix")
    schema = T.StructType(df.schema.fields + [
        T.StructField(n, f.dataType) for n, f in zip(names, FOUND)])
    at = df.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        for batch in batches:
            rows = []
            for t in batch.column(at).to_pylist():
                t = t or ""
                base = base_spans(t)
                more = random_spans(t, base, enc, max_ratio, min_length, word_ratio)
                every = sorted(base + more)
                told = joined(base)
                rows.append((sum(k == 0 for _, k, _ in base), sum(k == 1 for _, k, _ in base),
                             sum(k == 2 for _, k, _ in base), len(more), told,
                             hashlib.sha256(told.encode()).hexdigest(), joined(every),
                             mask(t, every, by) if masked else None))
            cols = list(zip(*rows)) if rows else [()] * len(FOUND)
            kinds = [pa.int64()] * 4 + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(list(c), k) for c, k in zip(cols, kinds)]],
                names=[*batch.schema.names, *names])

    return df.mapInArrow(scan, schema)
