"""Engine parameters.

Fixed values that must equal the reference engine's for the same results:
  BM25 k1 = 1.5, b = 0.75
  document expansion: seed = first 100 documents, similarity threshold > 0.5
  bulk indexing: chunks of 1000 documents
  frequent vocabulary: document frequency > 2 % of the document count
  query expansion: top_k 6 plus 1 = 7 neighbours per query word
  term weights: 1.2 per occurrence of an original word, 0.8 per expansion word
  blend: 0.6 * BM25 + 0.4 * cosine
  results page: top 5; evaluation cut-off k = 10
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    k1: float = 1.5
    b: float = 0.75
    seed_size: int = 100
    chunk_size: int = 1000
    expand_threshold: float = 0.5
    vocab_min_df_frac: float = 0.02
    neighbours: int = 7
    w_original: float = 1.2
    w_expanded: float = 0.8
    w_lexical: float = 0.6
    w_semantic: float = 0.4
    top_n: int = 5
    eval_k: int = 10
    # length of a ranked report
    report_n: int = 100
    # hashed embedders (stand-in for the neural model, see README)
    text_dim: int = 256
    term_dim: int = 256
    # bytes up to which a stored side is broadcast; beyond, its keys are salted
    broadcast_bytes: int = 16 << 20
    # pieces that a key is dealt to in a salted join
    salts: int = 16
    # digits kept when ordering by floating scores (stable ties)
    score_digits: int = 9

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
