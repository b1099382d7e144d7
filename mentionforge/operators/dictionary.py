"""All occurrences of a dictionary's terms in texts, by an automaton over folded characters.

Terms and texts are folded alike (composed, case-folded, white space collapsed); the automaton reads a text once,
whatever the number of terms, and each hit is mapped back to its span in the raw text. The dictionary is counted, and sent
to the tasks in blocks of bounded size; the texts are scanned once for each block."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionforge.functions.text import fold_text
from mentionforge.operators.rows import materialized
from mentionforge.operators.spans import FoldedText

#: Terms, and bytes of terms, in a block on average.
BLOCK_TERMS = 500_000
BLOCK_BYTES = 32 << 20
#: Texts of these characters alone, and without runs of white space, fold character by character.
PLAIN = re.compile("[\x00-˿Ḁ-ỿ‐-⁞]*")
RUN = re.compile(r"\s\s")


def folded(raw: str) -> tuple[str, np.ndarray | None, np.ndarray | None]:
    """A text folded, and of each folded character where its raw character (or cluster) begins and ends; None: one each."""
    if not PLAIN.fullmatch(raw) or RUN.search(raw):
        slow = FoldedText(raw)
        return slow.folded, np.array(slow.origin, np.int64), np.array(slow.beyond, np.int64)
    low = fold_text(raw)
    if len(low) == len(raw):
        return low, None, None  # no character folds to none, so each folds to one
    wide = np.fromiter((len(c.casefold()) for c in raw), np.int64, len(raw))
    origin = np.repeat(np.arange(len(raw)), wide)
    return low, origin, origin + 1


class Dictionary:
    """Terms by number, as an automaton; it is built where it is used, and sent as its terms."""

    def __init__(self, terms: Iterable[tuple[str, int]]):
        self.terms = list(terms)
        self.automaton = None

    def __getstate__(self):
        return self.terms

    def __setstate__(self, terms):
        self.__init__(terms)

    def built(self) -> ahocorasick.Automaton:
        if self.automaton is None:
            by_term: dict[str, list[int]] = {}
            for term, number in self.terms:
                if own := fold_text(term).strip():
                    by_term.setdefault(own, []).append(number)
            self.automaton = ahocorasick.Automaton()
            for own, numbers in by_term.items():
                self.automaton.add_word(own, (len(own), numbers))
            if by_term:
                self.automaton.make_automaton()
        return self.automaton

    def find(self, raw: str, whole_words: bool = True) -> list[tuple[int, int, int]]:
        """start, end, number of each occurrence, by place in the text. With whole_words no letter or digit at an end of
        an occurrence goes on beyond it."""
        automaton, out = self.built(), []
        if not len(automaton):
            return out
        text, origin, beyond = folded(raw)
        for last, (size, numbers) in automaton.iter(text):
            first = last - size + 1
            if whole_words and (first > 0 and text[first].isalnum() and text[first - 1].isalnum() or last + 1 < len(text) and text[last].isalnum() and text[last + 1].isalnum()):
                continue
            span = (first, last + 1) if origin is None else (int(origin[first]), int(beyond[last]))
            out += [(*span, n) for n in numbers]
        return sorted(out)


def longest(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of occurrences those that do not overlap: the first, of several that begin together the longest, and so on."""
    out, at = [], 0
    for start, end, number in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
        if start >= at:
            out.append((start, end, number))
            at = end
    return out


def blocks(terms: DataFrame, size: int) -> Iterator[Dictionary]:
    d = materialized(terms)
    n, wide = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()
    many = max(1, -(-n // size), -(-wide // BLOCK_BYTES))
    for k in range(many):
        part = d.filter(F.pmod(F.xxhash64("term", "number"), F.lit(many)) == k).toArrow()
        yield Dictionary(zip(part.column("term").to_pylist(), part.column("number").to_pylist(), strict=True))


def occurrences(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text", term_id: str = "term_id", term_col: str = "term", whole_words: bool = True, block: int = BLOCK_TERMS) -> DataFrame:
    """doc_id, term_id (a whole number), span_start, span_end of every occurrence of every term, overlapping ones included.
    Null texts and empty terms have none; terms that fold alike count each."""
    kind = dict(docs.dtypes)[id_col]
    own = terms.select(F.col(term_col).cast("string").alias("term"), F.col(term_id).cast("long").alias("number")).filter("term IS NOT NULL AND number IS NOT NULL")
    d, out = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).filter("text IS NOT NULL"), None
    for dictionary in blocks(own, block):
        shared = docs.sparkSession.sparkContext.broadcast(dictionary)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [shared.value.find(t.as_py(), whole_words) for t in b.column(1)]
                row = np.repeat(np.arange(len(b)), [len(f) for f in found])
                start, end, number = np.array([x for f in found for x in f], np.int64).reshape(-1, 3).T
                yield pa.record_batch([b.column(0).take(pa.array(row)), pa.array(number), pa.array(start), pa.array(end)], names=["doc_id", "term_id", "span_start", "span_end"])

        part = d.mapInArrow(run, f"doc_id {kind}, term_id long, span_start long, span_end long")
        out = part if out is None else out.unionAll(part)
    return out


def extractor(terms: dict[str, str]):
    """An extractor without a model (see models.extract_entities): the given terms (term to type), wherever they occur as
    whole words, the longest first, in order of the text and spelled as there."""
    names = list(terms)
    dictionary = Dictionary((t, k) for k, t in enumerate(names))

    def extract(text: str) -> list[dict]:
        return [{"text": text[a:z], "type": terms[names[k]], "assertions": []} for a, z, k in longest(dictionary.find(text))]

    return extract
