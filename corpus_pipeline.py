"""A training corpus from the documents table, in stages.

Each stage takes the documents its predecessor kept and returns a table; ``run`` writes
it as Parquet into the shared folder and reads it back as the next stage's documents.
What a stage has landed on its way is dropped once its result is written: by ``run`` for its
own stages, and, for those who call ``STAGES`` one after the other, by the next stage.
The last stage's tables stay, as its result reads them.
"""

from __future__ import annotations

from barline.llm import classifier, exact, mixing, packing, simhash
from barline.llm.common import table
from barline.plans import drop_landed, land, landed

_BUILD = [
    (
        "quality_classifier",
        lambda spark, docs, sf: classifier.accepted(docs, table(spark, sf, "labels")),
    ),
    ("exact_dedup", lambda spark, docs, sf: exact.without_copies(docs)),
    ("simhash_near_dedup", lambda spark, docs, sf: simhash.one_of_each(docs)),
    ("mixing", lambda spark, docs, sf: mixing.mix_documents(docs)),
    ("packing", lambda spark, docs, sf: packing.packed(docs)),
]


def _built(build, spark, docs, sf_dir):
    """The result of a stage, and the tables it has landed."""
    known = set(landed(spark))
    result = build(spark, docs, sf_dir)
    return result, [path for path in landed(spark) if path not in known]


# Stage -> tables landed by its last call through STAGES; ``run`` has no part in it.
_left: dict[str, list[str]] = {}


def _stage(name, build, before):
    def run_stage(spark, docs, sf_dir):
        """Needs the result of the stage before written, as its tables are dropped first."""
        drop_landed(spark, _left.pop(before, ()))
        result, _left[name] = _built(build, spark, docs, sf_dir)
        return result

    return name, run_stage


STAGES = [
    _stage(name, build, before)
    for (name, build), before in zip(_BUILD, [None, *[name for name, _ in _BUILD]], strict=False)
]

# Scores, fingerprints and token ids have no SQL form; the tests hold run() against a
# row-by-row version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, former = table(spark, sf_dir, "documents"), []
    for name, build in _BUILD[:-1]:
        result, mine = _built(build, spark, docs, sf_dir)
        docs = land(result, name)
        drop_landed(spark, [*mine, *former])
        former = landed(spark)[-1:]  # the table just written
    return _BUILD[-1][1](spark, docs, sf_dir)
