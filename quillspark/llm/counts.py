"""Token counts by a given tokenizer file, with whole-token shortcut: most pre-tokens are one token and need no merging.

Offline, once on the driver: every string of the vocabulary is encoded alone, and those that come out as one token are
kept. A pre-token that equals such a string is one token wherever it stands, since the merges see nothing but the
pre-token. In the tasks a text is cut into units (white space, then what isn't), where the tokenizer always cuts too;
units are cut into pre-tokens, those of the kept strings count 1, and only the others are merged by the library. Units'
counts are remembered, a bounded number of them, so a unit is cut once a worker.

The split pattern's classes follow a version of Unicode, so units with characters outside ranges that all versions
agree on, and units with a special string, go to the library as they are. Files of other kinds than byte-level merges
without a normaliser have no such shortcut: their texts go to the library whole.

It is one pass over the texts without a shuffle. The tokenizer's file is read on the driver and broadcast (1.5 MB);
the kept strings are no more than its vocabulary.

Defined cases: a null or empty text has no bytes and no tokens. Texts of any length are counted whole, piece by piece
where white space allows it. Rows are counted each for itself, whatever their ids; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the tokenizers' files.
FOLDER = "/opt/tokenizers"
#: The public split pattern of byte-level pair encodings, and the characters of Unicode's White_Space.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Ranges in which the classes of letters, numbers and blanks are the same in all versions of Unicode in use.
CERTAIN = "\\x00-\\u0557\\u2000-\\u206f\\u20a0-\\u20bf\\u2190-\\u21ff"
#: Units that a worker remembers, and the characters of the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Characters of a text that are cut into units at once.
PIECE = 1 << 20

_UNIT = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
_EDGE = re.compile(f"(?<=[^{BLANK}])[{BLANK}]")
_UNCERTAIN = re.compile(f"[^{CERTAIN}]")
_PRE = regex.compile(SPLIT)


def byte_level(spec: dict) -> bool:
    """Whether a tokenizer (its JSON) is byte-level merges with the public split and nothing before or after."""
    pre = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    specials = all(not a["lstrip"] and not a["rstrip"] and not a["single_word"] and not re.search(f"[{BLANK}]", a["content"]) for a in spec.get("added_tokens", []))
    return plain and specials and (spec.get("model") or {}).get("type") == "BPE"


def _library(data: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data)
    t.no_padding()
    t.no_truncation()
    return t


def whole_tokens(data: str) -> list[str]:
    """The strings of the vocabulary that encode alone as one token."""
    t = _library(data)
    texts = [s for s in (t.decode([i], skip_special_tokens=False) for i in range(t.get_vocab_size())) if s and "�" not in s]
    return [s for s, e in zip(texts, t.encode_batch(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1]


class Counter(dict):
    """Tokens of units; what it doesn't hold yet is cut into pre-tokens and merged where that is needed."""

    def __init__(self, data: str, whole: list[str]):
        self._encode = _library(data).encode
        self._whole = dict.fromkeys(whole, 1)
        self._special = [a["content"] for a in json.loads(data).get("added_tokens", [])]
        self.merged = 0
        super().__init__(self._whole)

    def __missing__(self, unit: str) -> int:
        if _UNCERTAIN.search(unit) or any(s in unit for s in self._special):
            n = self._merge(unit)
        else:
            n = sum(1 if p in self._whole else self._merge(p) for p in _PRE.findall(unit))
        if len(unit) <= LONGEST:
            if len(self) > REMEMBERED:
                self.clear()
                self.update(self._whole)
            self[unit] = n
        return n

    def _merge(self, text: str) -> int:
        self.merged += 1
        return len(self._encode(text, add_special_tokens=False).ids)

    def of(self, text: str) -> int:
        n = at = 0
        while at < len(text):
            edge = _EDGE.search(text, at + PIECE)
            end = edge.start() if edge else len(text)
            n += sum(map(self.__getitem__, _UNIT.findall(text, at, end)))
            at = end
        return n


_HELD: dict[int, object] = {}


def _counting(data: bytes, whole: list[str] | None, kind: str):
    """The function of a text that counts its tokens; a worker keeps the last one."""
    key = hash(data)
    if key not in _HELD:
        _HELD.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if kind == "model":
            from sentencepiece import SentencePieceProcessor

            p = SentencePieceProcessor(model_proto=data)
            _HELD[key] = lambda text: len(p.encode(text))
        elif whole is None:
            t = _library(data.decode())
            _HELD[key] = lambda text: len(t.encode(text, add_special_tokens=False).ids)
        else:
            _HELD[key] = Counter(data.decode(), whole).of
    return _HELD[key]


def counted(documents: DataFrame, file: str = f"{FOLDER}/byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than the limit) of every row."""
    with open(file, "rb") as f:
        data = f.read()
    kind = file.rpartition(".")[2]
    whole = whole_tokens(data.decode()) if kind == "json" and byte_level(json.loads(data)) else None
    shared = documents.sparkSession.sparkContext.broadcast((data, whole, kind))

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counting(*shared.value)
        for batch in it:
            text = batch.column("text")
            n = pa.array([count(x.as_py()) for x in text], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(step, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
