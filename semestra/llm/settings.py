"""Production parameters that queries and the pipeline share."""

from __future__ import annotations

import public_tokenizers

#: Shares of the languages' words in the mixture.
TARGETS = {"en": 0.60, "de": 0.15, "fr": 0.15, "es": 0.10}
#: Lines found in at least this many documents go.
COMMON_LINE = 10
#: Words of a shingle, and bits that linked fingerprints differ in at most.
SHINGLE, DISTANCE = 3, 2
#: Share of candidate merges that are skipped, and the seed of the skips.
DROPOUT, SEED = 0.1, 20
#: SentencePiece cuts text by this model; its content travels with the tasks.
MODEL = "piece_bpe_32k.model"


def model_bytes(name: str = MODEL) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()
