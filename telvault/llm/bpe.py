"""Byte-level BPE: encoding by prefix dynamic programming, decoding, and edits.

The BPE encoding of a byte string is unique, and so is the last token of each of
its prefixes. ``last[i]`` holds that token for the first ``i`` bytes: among the
tokens that end at ``i`` it is the one that may follow ``last[i - length]``,
that is, whose pair would stay unmerged. Walking back from the end gives the
whole encoding. Appending bytes only adds entries, so sorted strings are encoded
together, each from the prefix it shares with the one before; an edit re-does the
entries after it, and a document's other pattern matches are kept (``Encoded``).

``encode``, ``decode`` and ``digests`` map Arrow batches in Python workers. Each
worker keeps the vocabulary and bounded caches of matches and token pairs; a text
is one cell and is held whole, nothing else grows with the input.

Defined results: null or empty text gives no ids and decodes to an empty string;
repeated rows repeat; columns besides those named are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from telvault.llm.common import give_back, hold

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHED = 200_000  # matches that a worker keeps, and as many that it kept before
SEAMS = 500_000  # token pairs that a worker keeps
# fixed values: letters and numbers of later Unicode versions than tiktoken's, which it treats as unassigned
RECENT = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    r"\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    r"\U0003d000-\U0003fc3f")
SHORT = 40  # matches of over twice as many characters are not kept


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class PrefixBpe:
    """Encoder of byte strings by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        ends: dict[bytes, set[int]] = {}  # sizes of the tokens that end with these two or three bytes
        for t in ranks:
            for n in (2, 3):
                if len(t) >= n:
                    ends.setdefault(t[-n:], {1}).add(len(t))
        for k, sizes in ends.items():
            if len(k) == 3 and k[1:] in ranks:
                sizes.add(2)
        self.ends = {k: tuple(sorted(sizes, reverse=True)) for k, sizes in ends.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.seams: dict[tuple[int, int], bool] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; a byte gives itself twice; None if no merge makes it."""
        if token in self.halves:
            return self.halves[token]
        data = self.tokens[token]
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            least, at = min((self.ranks.get(parts[i] + parts[i + 1], token), i) for i in range(len(parts) - 1))
            if least >= token:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        got = (token, token) if len(data) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        self.halves[token] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """Whether BPE leaves ``a`` and ``b`` side by side.

        It does if it would not have merged across the seam at any time while it made the two. Merges are undone from
        the newest on (a merge's time is the rank of what it makes; of equal ranks the left one is the older): at each
        step the pair that meets at the seam may have no merge older than what was undone last, for BPE takes the
        oldest merge first. With only bytes left on one side nothing is to be undone.
        """
        tokens, ranks = self.tokens, self.ranks
        limit = len(tokens) + 256 + max(a, b)
        while True:
            merged = ranks.get(tokens[a] + tokens[b])
            if merged is not None and merged < limit:
                return False
            if a > b:
                limit, a = a, self.split(a)[1]
                if a == limit:
                    limit, b = b + 1, self.split(b)[0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.split(b)[0]
                if b + 1 == limit:
                    limit, a = a, self.split(a)[1]
                    if a == limit:
                        return True

    def fits(self, seam: tuple[int, int]) -> bool:
        if len(self.seams) >= SEAMS:
            self.seams.clear()
        got = self.seams[seam] = self.split(seam[1]) is not None and self.may_follow(*seam)
        return got

    def extend(self, data: bytes, last: list[int]) -> None:
        """Add the entries of ``last`` (entry 0 is unused) that ``data`` has beyond it."""
        get, ends, seams = self.ranks.get, self.ends.get, self.seams.get
        for i in range(len(last), len(data) + 1):
            for n in (i > 2 and ends(data[i - 3:i])) or (i > 1 and ends(data[i - 2:i])) or (1,):
                if n > i:
                    continue
                token = get(data[i - n:i])
                if token is None:
                    continue
                if n == i:
                    good = self.split(token) is not None
                else:
                    seam = (last[i - n], token)
                    good = seams(seam)
                    if good is None:
                        good = self.fits(seam)
                if good:
                    last.append(token)
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[i - 1]:#x}")

    def walk(self, last: list[int]) -> list[int]:
        out, i, sizes = [], len(last) - 1, self.sizes
        while i:
            out.append(last[i])
            i -= sizes[last[i]]
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        token = self.ranks.get(data)
        if token is not None:  # a match that is a token is that token, reachable by merges or not
            return [token]
        last = [-1]
        self.extend(data, last)
        return self.walk(last)

    def encode_all(self, strings: list[bytes]) -> Iterator[list[int]]:
        """Ids of each of the sorted ``strings``: the entries of a prefix that two neighbours share are kept."""
        before, last = b"", [-1]
        for data in strings:
            token = self.ranks.get(data)
            if token is not None:
                yield [token]
                continue
            del last[shared(before, data) + 1:]
            self.extend(data, last)
            before = data
            yield self.walk(last)


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if len(a) + len(b) < 200:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


class Known(dict):
    """What is known of matches: (ids, their decimal text, the bytes that they decode to). When full, what has not been
    met since the last time it was full is forgotten. Matches over ``2 * SHORT`` characters are not kept."""

    def __init__(self, bpe: PrefixBpe):
        self.bpe, self.old = bpe, {}

    def entry(self, ids: list[int]) -> tuple[tuple[int, ...], bytes, bytes]:
        return tuple(ids), b",".join([b"%d" % i for i in ids]), b"".join(map(self.bpe.tokens.__getitem__, ids))

    def make_room(self) -> None:
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()

    def __missing__(self, match: str) -> tuple[tuple[int, ...], bytes, bytes]:
        got = self.old.get(match)
        if got is None:
            got = self.entry(self.bpe.encode(match.encode()))
        if len(match) <= 2 * SHORT:
            self.make_room()
            self[match] = got
        return got

    def learn(self, matches: set[str]) -> None:
        """Take up many matches at a time, sorted, so that they share prefixes."""
        self.make_room()
        new = matches.difference(self)
        for m in new.intersection(self.old):
            self[m] = self.old[m]
        new = sorted(m.encode() for m in new.difference(self.old) if len(m) <= 2 * SHORT)
        for data, ids in zip(new, self.bpe.encode_all(new)):
            self[data.decode()] = self.entry(ids)


class Codec:
    """Texts to ids and back, by a rank file's content and the pattern that splits texts."""

    def __init__(self, content: bytes, pattern: str = public_tokenizers.PATTERN):
        self.bpe = PrefixBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a})
        self.matches = regex.compile(pattern)
        self.recent = re.compile(f"[{RECENT}]")
        self.strict = None if pattern != public_tokenizers.PATTERN else regex.compile(
            pattern.replace(r"\p{L}", rf"[\p{{L}}--[{RECENT}]]").replace(r"\p{N}", rf"[\p{{N}}--[{RECENT}]]"), regex.V1)
        self.known = Known(self.bpe)

    def is_recent(self, text: str) -> bool:
        """Whether a character of ``RECENT`` occurs."""
        try:
            text.encode("latin-1")  # many times as fast as a search; RECENT begins beyond
            return False
        except UnicodeEncodeError:
            return self.recent.search(text) is not None

    def pattern_for(self, text: str):
        """The pattern; where a text has a character of ``RECENT``, the same with those not letters or numbers."""
        return self.strict if self.strict and self.is_recent(text) else self.matches

    def entries(self, text: str) -> list[tuple[tuple[int, ...], bytes, bytes]]:
        """What is known of each match."""
        return list(map(self.known.__getitem__, self.pattern_for(text).findall(text)))

    def entries_of(self, texts: list[str | None]) -> Iterator[list[tuple[tuple[int, ...], bytes, bytes]]]:
        """``entries`` of each text; matches not yet known are encoded together."""
        same: dict[str, str] = {}  # equal matches are one object, or the matches would take many times the texts' memory
        found = []
        for t in texts:
            matches = self.pattern_for(t).findall(t) if t else []
            found.append(list(map(same.setdefault, matches, matches)))
        self.known.learn(set(same))
        for matches in found:
            yield list(map(self.known.__getitem__, matches))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(e[0] for e in self.entries(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bpe.tokens.__getitem__, ids))

    def edit(self, text: str, ids: list[int], start: int, end: int, new: str) -> tuple[str, list[int]]:
        """``text`` with [start, end) replaced by ``new``, and its ids. For several edits of a text keep its ``Encoded``."""
        held = Encoded(self, text)
        held.edit(start, end, new)
        return held.text, held.ids


class Encoded:
    """A text with its ids, kept right through edits.

    Held are where matches begin, where their ids begin, and the prefix entries of the long match encoded last. An edit
    finds its match by bisection. Matches are found from left to right and look one character ahead at most, so those
    that end before the character in front of the edit stay; the first boundary behind the edit that was one before
    ends the work. Of a long match only the entries from the edit's byte on are made anew.
    """

    def __init__(self, codec: Codec, text: str):
        self.codec = codec
        self.take(text)

    def take(self, text: str) -> None:
        self.text, self.pattern = text, self.codec.pattern_for(text)
        self.table: tuple[bytes, list[int]] = b"", [-1]
        found = [(m.start(), self.ids_of(m.group())) for m in self.pattern.finditer(text)]
        self.starts = np.array([at for at, _ in found], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for _, x in found], dtype=np.int64)])
        self.ids = [i for _, x in found for i in x]

    def ids_of(self, match: str) -> Iterable[int]:
        if len(match) <= 2 * SHORT:
            return self.codec.known[match][0]
        data, bpe = match.encode(), self.codec.bpe
        before, last = self.table
        del last[shared(before, data) + 1:]
        bpe.extend(data, last)
        self.table = data, last
        return [bpe.ranks[data]] if data in bpe.ranks else bpe.walk(last)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace [start, end) by ``new``."""
        codec, old, recent = self.codec, self.text, self.pattern is self.codec.strict
        changed = old[:start] + new + old[end:]
        if codec.strict and (codec.is_recent(old[start:end]) if recent else codec.is_recent(new)) and codec.pattern_for(changed) is not self.pattern:
            self.take(changed)
            return
        shift, behind = len(changed) - len(old), start + len(new)
        first = max(0, int(np.searchsorted(self.starts, start - 1)) - 1)
        found, rest = [], len(self.starts)
        for m in self.pattern.finditer(changed, int(self.starts[first]) if rest else 0):
            at = m.start()
            if at >= behind:
                k = int(np.searchsorted(self.starts, at - shift))
                if k < len(self.starts) and self.starts[k] == at - shift:
                    rest = k
                    break
            found.append((at, self.ids_of(m.group())))
        cut = int(self.offsets[first]), int(self.offsets[rest])
        sizes = np.cumsum([len(x) for _, x in found], dtype=np.int64)
        more = cut[0] + (int(sizes[-1]) if found else 0) - cut[1]
        self.ids[slice(*cut)] = [i for _, x in found for i in x]
        self.offsets = np.concatenate([self.offsets[:first + 1], cut[0] + sizes[:-1], self.offsets[rest:] + more] if found
                                      else [self.offsets[:first], self.offsets[rest:] + more])
        self.starts = np.concatenate([self.starts[:first], np.array([at for at, _ in found], np.int64), self.starts[rest:] + shift])
        self.text = changed


_CODECS: dict[str, Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """The worker's codec of a vocabulary, made once."""
    key = hashlib.md5(content).hexdigest() + pattern
    if key not in _CODECS:
        _CODECS[key] = Codec(content, pattern)
    return _CODECS[key]


class Stages:
    """The mapped functions; the vocabulary is a broadcast of the rank file (under 1 MB, whatever the input)."""

    def __init__(self, spark: SparkSession, path: str | None, pattern: str):
        self.content = spark.sparkContext.broadcast(load_ranks(path or public_tokenizers.path(RANKS)))
        self.pattern = pattern

    @contextmanager
    def codec(self) -> Iterator[Codec]:
        """The worker's codec."""
        hold("bpe", _CODECS.clear)
        try:
            yield codec(self.content.value, self.pattern)
        finally:
            give_back()

    def encode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, text) to (id, ids)."""
        with self.codec() as c:
            for b in batches:
                for part in pieces_of(b):
                    ids = [list(chain.from_iterable(e[0] for e in found)) for found in c.entries_of(part.column(1).to_pylist())]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[part.schema.names[0], "ids"])

    def decode(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, ids) to (id, bytes)."""
        c = codec(self.content.value, self.pattern)
        for b in batches:
            data = [c.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=[b.schema.names[0], "data"])

    def digests(self, batches: Iterator[pa.RecordBatch], with_ids: bool = False) -> Iterator[pa.RecordBatch]:
        """(id, text) to (id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids, each match's once while known."""
        hexdigest = lambda data: hashlib.sha256(data).hexdigest()
        with self.codec() as c:
            for batch in batches:
                for b in pieces_of(batch, 8 << 20):
                    n, a, d, kept = [], [], [], []
                    for found in c.entries_of(b.column(1).to_pylist()):
                        ids = [e[0] for e in found]
                        n.append(sum(map(len, ids)))
                        a.append(hexdigest(b",".join([e[1] for e in found])))
                        d.append(hexdigest(b"".join([e[2] for e in found])))
                        if with_ids:
                            kept.extend(chain.from_iterable(ids))
                    columns = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array([0, *accumulate(n)], pa.int32()), pa.array(kept, pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names=[b.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)])

    def tokens(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The same with the ids behind."""
        return self.digests(batches, with_ids=True)


def pieces_of(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, a row at least."""
    rows = max(1, min(batch.num_rows, int(batch.num_rows * most / max(1, batch.nbytes))))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def encode(df: DataFrame, id_col: str, text_col: str, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, ids array<int>) per row. ``path`` names a rank file; by default the multilingual one."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(Stages(df.sparkSession, path, pattern).encode, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, id_col: str, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, data binary) per row of ids."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(Stages(df.sparkSession, path, public_tokenizers.PATTERN).decode, f"`{id_col}` {kind}, data binary")


def digests(df: DataFrame, id_col: str, text_col: str, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: the round trip without moving the ids to the JVM."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        Stages(df.sparkSession, path, pattern).digests, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokens(df: DataFrame, id_col: str, text_col: str, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``digests`` and the ids (array<int>) per row."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        Stages(df.sparkSession, path, pattern).tokens,
        f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
