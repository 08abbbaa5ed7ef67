"""Scoring of texts with a weighted backoff automaton.

States are the contexts of a smoothed bigram model: the beginning of a text and each training word, and below them
the empty context. A state has an arc for each word that followed it in training; other words take the failure arc to
the empty context, which has an arc for every word, known or not. Each text is traversed once from left to right:
the state after a word is that word's, and the log-probabilities of the arcs taken add up.

A corpus has far more arcs than a task can hold. So every block of texts gets the states and arcs that its own texts
can reach: it asks for the counts of its words and word pairs, which are counted over all blocks, and builds its part
of the automaton from the answers. Scores are those of the whole automaton.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .blocks import Block, answered, count_keys, make_blocks, mixed, tally, totals, words

_TRAIN = "_llm_train"
_END, _BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass(frozen=True)
class _Tokens:
    """A block's tokens, each document's end token included, as places in the sorted list of distinct ones."""

    distinct: np.ndarray
    token: np.ndarray
    #: The token before, as a place in ``contexts``.
    contexts: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    trains: np.ndarray

    @property
    def pairs(self) -> np.ndarray:
        before, after = self.contexts[self.context], self.distinct[self.token]
        return mixed(before * np.uint64(0x9FB21C651E98DF25) ^ (after + (before >> np.uint64(32))))


def _tokens(block: Block) -> _Tokens:
    word, doc, per_doc = words(block)
    n = len(word) + len(per_doc)
    token, before, ends = np.empty(n, np.uint64), np.empty(n, np.uint64), np.cumsum(per_doc + 1) - 1
    inner = np.ones(n, bool)
    inner[ends] = False
    token[inner], token[ends] = word, _END
    before[1:] = token[:-1]
    before[np.concatenate(([0], ends[:-1] + 1))] = _BEGIN
    distinct, at = np.unique(token, return_inverse=True)
    contexts, context = np.unique(before, return_inverse=True)
    of = np.repeat(np.arange(len(per_doc)), per_doc + 1)
    return _Tokens(distinct, at, contexts, context, of, np.asarray(block.rows.column(_TRAIN).to_numpy(zero_copy_only=False), bool))


def _word_requests(block: Block) -> tuple[np.ndarray, ...]:
    t = _tokens(block)
    return t.distinct, np.bincount(t.token, t.trains[t.doc], minlength=len(t.distinct)).astype(np.int64)


def _pair_requests(block: Block) -> tuple[np.ndarray, ...]:
    t = _tokens(block)
    return tally(t.trains[t.doc], t.pairs)[0]


def _follower_requests(block: Block) -> tuple[np.ndarray, ...]:
    """Contexts, each with the number of its arcs that this block owns: summed up, the arcs of the context's state."""
    t = _tokens(block)
    _, owned = answered(block, 0)
    _, pair = tally(t.trains[t.doc], t.pairs)
    of = np.empty(len(owned), np.int64)
    of[pair] = t.context  # a pair has one context
    return t.contexts, np.bincount(of[owned], minlength=len(t.contexts)).astype(np.int64)


@dataclass(frozen=True)
class Automaton:
    """The part of the automaton that some tokens can reach. Arcs are log10 probabilities."""

    #: Per word: the arc of the empty context.
    root: np.ndarray
    #: Per context: the weight of the failure arc; 0 where the context is no state, as no training text has it.
    failure: np.ndarray
    #: Per pair of context and word: the arc, not a number where the state has none.
    arcs: np.ndarray

    def walk(self, context: np.ndarray, token: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """The log10 probability that each step takes, where the step before has led to ``context``."""
        arc = self.arcs[pair]
        return np.where(np.isnan(arc), self.failure[context] + self.root[token], arc)


def build(word_count, pair_count, pair_context, pair_word, context_count, context_arcs, n_train, n_words, discount) -> Automaton:
    """From counts over the training texts. A state keeps ``discount`` of each arc for the failure arc; that share of
    the empty context's probability also goes to the state's own arcs, so that all words together have 1."""
    p_root = (word_count + 1) / (n_train + n_words + 1)
    known = context_count > 0
    held = np.where(known, discount * context_arcs / np.maximum(context_count, 1), 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.maximum(pair_count - discount, 0) / np.maximum(context_count[pair_context], 1)
        arcs = np.where(pair_count > 0, np.log10(share + held[pair_context] * p_root[pair_word]), np.nan)
        return Automaton(np.log10(p_root), np.log10(held), arcs)


def score_texts(documents: DataFrame, trains: Column, text: str = "text") -> DataFrame:
    """All columns of ``documents`` but the text, and ``SCORES``; the model learns from the rows where ``trains``.

    A text's tokens are its words and one end, so a null or empty text has one token. ``base_score`` is the sum of
    the empty context's log10 probabilities, ``score`` that of the automaton. Rows with equal texts score alike.
    Without training rows, every token has probability 1 / 1. Columns named like a score are replaced.
    """
    names = [f.split()[0] for f in SCORES.split(", ")]
    kept = [c for c in documents.columns if c not in (*names, text, _TRAIN)]
    marked = documents.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`"), F.coalesce(trains, F.lit(False)).alias(_TRAIN))
    blocks = make_blocks(marked, text)
    word_counts = count_keys(blocks.ask(_word_requests))
    n_words, n_train, *_ = (int(x) for x in totals(word_counts))
    pair_counts = count_keys(blocks.ask(_pair_requests))
    _, _, once, twice, *_ = totals(pair_counts)
    discount = float(once / (once + 2 * twice)) if once and twice else 0.5
    arc_counts = count_keys(blocks.ask(_follower_requests, pair_counts))
    schema = T.StructType([*documents.select(*(F.col(f"`{c}`") for c in kept)).schema, *T.StructType.fromDDL(SCORES)])

    def score(block: Block) -> Iterator[pa.RecordBatch]:
        t = _tokens(block)
        (count_of, _), (pair_count, _), (context_arcs, _) = (answered(block, i) for i in range(3))
        _, pair = tally(t.trains[t.doc], t.pairs)
        pair_context, pair_word = np.empty(len(pair_count), np.int64), np.empty(len(pair_count), np.int64)
        pair_context[pair], pair_word[pair] = t.context, t.token
        # A context is followed as often as it occurs, the beginning as often as the end.
        at = np.searchsorted(t.distinct, np.where(t.contexts == _BEGIN, _END, t.contexts))
        at = np.minimum(at, len(t.distinct) - 1)
        automaton = build(count_of, pair_count, pair_context, pair_word, count_of[at], context_arcs, n_train, n_words, discount)
        steps, base = automaton.walk(t.context, t.token, pair), automaton.root[t.token]
        n = len(block.ends)
        columns = [
            np.bincount(t.doc, minlength=n), np.bincount(t.doc, count_of[t.token] > 0, minlength=n).astype(np.int64),
            np.full(n, n_train), np.bincount(t.doc, base, minlength=n), np.bincount(t.doc, steps, minlength=n),
        ]
        rows = block.rows.drop_columns([_TRAIN]).combine_chunks()
        for name, values in zip(names, columns, strict=True):
            rows = rows.append_column(name, pa.array(values))
        yield from rows.to_batches()

    return blocks.each(score, schema, word_counts, pair_counts, arc_counts)
