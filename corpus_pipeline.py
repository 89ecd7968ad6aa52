"""The corpus pipeline: toxic documents and near copies go, secrets are masked, the rest is packed into sequences."""

from __future__ import annotations

from ledgerlens.llm import stages as S

STAGES = [
    ("toxicity", S.without_toxic),
    ("near_duplicates", S.without_near_copies),
    ("secrets", S.without_secrets),
    ("packing", S.in_sequences),
]

#: The stages learn from labels, estimate similarities and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to all of ``documents``: the pieces of the kept documents with their places."""
    return S.run(spark, sf_dir, STAGES)
