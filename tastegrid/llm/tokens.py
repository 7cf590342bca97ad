"""Token counts by the whole-token shortcut.

Which strings of the vocabulary encode alone as one token is proved once, by encoding each of them with the
library. Texts are split into pre-tokens as the tokenizer splits them; a proved pre-token counts one without
any merge, and only the rest goes through the merges, each different pre-token once per task while the
bounded memory of counts holds it. Splitting follows the library's tables character by character: a text with a
character that is not proved alike goes to the library whole, and so does every text if the file has another
normalizer or pre-tokenizer than the one that is followed here.

Nulls, ties and odd rows: a null text counts as the empty one, 0 bytes and 0 tokens; the strings of special
tokens inside a text count one token each, as the library takes them by default; repeated rows give equal
results; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import partial
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose counts a task keeps; pre-tokens that one step holds at a time; characters of one step.
KEPT, STEP, STEP_CHARS = 400_000, 200_000, 1 << 20
LIMIT = 2048


def proved_whole(vocabulary: str) -> frozenset[str]:
    """The texts that encode alone as exactly one token, by encoding every string of the vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    strings += _plain_strings(json.loads(vocabulary)["model"]["vocab"])
    strings = list(dict.fromkeys(s for s in strings if s and s == s.lower()))
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    special = {t["content"] for t in json.loads(vocabulary)["added_tokens"]}
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1 and s not in special)


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable bytes stand for themselves, the rest for 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _plain_strings(vocabulary: dict[str, int]) -> list[str]:
    letters, out = _byte_letters(), []
    for entry in vocabulary:
        body = entry.removesuffix("</w>")
        if all(c in letters for c in body):
            try:
                out.append(bytes(letters[c] for c in body).decode())
            except UnicodeDecodeError:
                continue
    return out


#: The normalizer and pre-tokenizer that ``PreTokens`` stands for.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Categories of symbols: they take no part in compositions, whatever the version of the Unicode tables.
SYMBOLS = {"So", "Sk", "Sm", "Sc", "Cf"}


def is_known(vocabulary: str) -> bool:
    """True if the file's normalizer and pre-tokenizer are those of ``PreTokens``; else the library counts alone."""
    made = json.loads(vocabulary)
    steps = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    pattern = (steps[0].get("pattern") or {}).get("Regex")
    levels = [(p.get("type"), p.get("add_prefix_space"), p.get("use_regex")) for p in steps[1:]]
    cut = (steps[0].get("behavior"), steps[0].get("invert"))
    return made.get("normalizer") == NORMALIZER and pattern == SPLIT and cut == ("Removed", True) and levels == [("ByteLevel", False, False)]


class Proof:
    """Which characters this module and the library treat alike, proved one by one as they turn up.

    A character is proved if its composition is settled (it is as old as Unicode 3.2, or a symbol) and both
    split it, alone and between letters, digits and signs, into the same pieces.
    """

    def __init__(self, tokenizer, split: PreTokens):
        self.normalizer, self.cutter, self.split, self.known = tokenizer.normalizer, tokenizer.pre_tokenizer, split, {}
        self.letters = _byte_letters()

    def pieces(self, text: str) -> list[str]:
        """The library's own pre-tokens."""
        made = self.cutter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(self.letters[c] for c in p).decode() for p, _ in made]

    def holds(self, text: str) -> bool:
        if text.isascii():
            return True
        for c in set(text) - self.known.keys():
            settled = unicodedata.ucd_3_2_0.category(c) != "Cn" or unicodedata.category(c) in SYMBOLS
            probes = (c, f"a{c}a", f"1{c}1", f"!{c}!")
            self.known[c] = c.isascii() or (settled and all(self.pieces(p) == self.split.listed(p) for p in probes))
        return all(map(self.known.__getitem__, set(text)))


def slices(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at a space before an ASCII letter or digit: nothing joins across it."""
    first = 0
    for m in re.finditer(r" (?=[A-Za-z0-9])", text):
        if m.start() - first >= size:
            yield text[first : m.start()]
            first = m.start()
    yield text[first:]


class PreTokens:
    """Splits texts as the tokenizer does: specials, NFC, lower case, then its pattern without white space."""

    def __init__(self, specials: list[str]):
        import regex

        # fixed values: the tokenizer's own pattern; plain texts need no Unicode classes
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+")
        self.wide = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None

    def parts(self, text: str) -> tuple[list[str], int]:
        """The ordinary parts of a text and its number of special strings."""
        if self.specials is None:
            return [text], 0
        found = self.specials.split(text)
        return found, len(found) - 1

    def split(self, part: str) -> Iterator[str]:
        if part.isascii():
            return (m.group() for m in self.plain.finditer(part.lower()))
        part = unicodedata.normalize("NFC", part)
        # letter by letter: a whole string would give a final sigma its other form
        part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
        return (m.group() for m in self.wide.finditer(part))

    def listed(self, part: str) -> list[str]:
        if part.isascii():
            return self.plain.findall(part.lower())
        return list(self.split(part))


def _count(batches: Iterator[pa.RecordBatch], vocabulary: str, whole: frozenset[str], limit: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    split = PreTokens([t["content"] for t in json.loads(vocabulary)["added_tokens"]])
    counts = dict.fromkeys(whole, 1)
    known, proof = is_known(vocabulary), Proof(tokenizer, split)

    def learn(pre_tokens: set[str]) -> None:
        if len(counts) > len(whole) + KEPT:
            counts.clear()
            counts.update(dict.fromkeys(whole, 1))
        new = list(pre_tokens - counts.keys())
        for s, e in zip(new, tokenizer.encode_batch(new, add_special_tokens=False)):
            counts[s] = len(e.ids)

    for batch in batches:
        sizes: list[int] = []
        waiting: list[tuple[list[str], int]] = []
        held = 0

        def settle_waiting() -> None:
            learn(set(chain.from_iterable(w for w, _ in waiting)))
            for tokens, extra in waiting:
                sizes.append(extra + sum(map(counts.__getitem__, tokens)))
            waiting.clear()

        for scalar in batch.column(1):
            text = scalar.as_py() or ""
            if not (known and proof.holds(text)):  # the library takes the text itself
                settle_waiting()
                held, cut = 0, slices(text, STEP_CHARS) if known else [text]
                sizes.append(sum(len(tokenizer.encode(s, add_special_tokens=False).ids) for s in cut))
                continue
            parts, extra = split.parts(text)
            if len(text) > STEP_CHARS:  # a very long text goes through in steps, by itself
                settle_waiting()
                held, total = 0, extra
                for part in parts:
                    pre = iter(split.split(part))
                    while step := list(islice(pre, STEP)):
                        learn(set(step))
                        total += sum(map(counts.__getitem__, step))
                sizes.append(total)
                continue
            tokens = split.listed(parts[0]) if len(parts) == 1 else list(chain.from_iterable(map(split.listed, parts)))
            waiting.append((tokens, extra))
            held += len(tokens)
            if held > STEP:
                settle_waiting()
                held = 0
        settle_waiting()
        n = pa.array(sizes, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), n], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; ``vocabulary_path`` is read on the driver."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"))
    # the vocabulary file and its strings are of fixed size
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, proved_whole(vocabulary)))
    counted = rows.mapInArrow(partial(_count_shared, shared=shared, limit=limit), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _count_shared(batches: Iterator[pa.RecordBatch], shared, limit: int) -> Iterator[pa.RecordBatch]:
    yield from _count(batches, *shared.value, limit)
