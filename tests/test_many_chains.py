"""Chains of many groups at a time and gene chains that go on from the last one, against chaining anew, a group and a chain at a time."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lociweave.operators import chains
from lociweave.operators.transcript_chains import transcript_chains
from lociweave.plans import calls as C


def group(rng, hits, numbers=5):
    blocks = [(30 * k, 30 * k + 29, rng.choice([10.0, 33.3, 47.1, 60.0, 95.0, 100 / 7])) for k in range(12)]
    out = []
    for _ in range(hits):
        a, z, score = rng.choice(blocks)
        s = rng.randint(a, z - 1)
        out.append({
            "number": rng.randint(1, numbers), "exon_id": f"E{rng.randint(1, 4)}", "start": s, "end": rng.randint(s + 1, z), "block_start": a, "block_end": z, "score": score,
            "length": rng.randint(1, 9), "exon_score": float(rng.randint(1, 9)), "bases": rng.randint(1, 9),
        })
    return out


@pytest.mark.parametrize("strand", ["+", "-"])
@pytest.mark.parametrize("most", [1, 10])
def test_chains_of_many_groups_equal_those_of_each(strand, most):
    rng = random.Random(5)
    for width in (1, 2, 3, 5, 9, 16):
        groups = [group(rng, width) for _ in range(80)]
        place = lambda h: (h["start"], h["end"]) if strand == "+" else (-h["end"], -h["start"])
        cells = lambda f: np.array([[f(h) for h in g] for g in groups])
        named = [cells(lambda h, n=n: h[n]) for n in ("block_start", "block_end", "score", "bases")]
        made = transcript_chains(cells(lambda h: h["number"]), cells(lambda h: place(h)[0]), cells(lambda h: place(h)[1]), *named, most)
        found, at = {}, 0
        for k, n, raw in zip(made.group.tolist(), made.sizes.tolist(), made.raw.tolist(), strict=True):
            found.setdefault(k, []).append((made.places[at : at + n].tolist(), raw))
            at += n
        base = {"strand": strand, "expected": 9, "coding": False, "mane": False, "coding_x": 1.0, "complete_x": 1.0, "mane_x": 1.0}
        for k, hits in enumerate(groups):
            own = chains.chain_places(hits, strand, "transcript", None, most)
            assert found[k] == [([i for i, _ in c], chains.scored(base, [{**hits[i], "inserted": False} for i, _ in c])["raw"]) for c in own]


@pytest.mark.parametrize("strand", ["+", "-"])
def test_gene_chains_go_on_as_if_begun_anew(strand):
    rng = random.Random(6)
    for max_gap in (None, 40):
        for _ in range(200):
            hits = group(rng, rng.randint(1, 18), 7)
            free, anew = list(range(len(hits))), []
            while free and len(anew) < 10:
                anew.append(chains.gene_chain(hits, free, strand, max_gap))
                used = {(hits[i]["block_start"], hits[i]["block_end"]) for i, _ in anew[-1]}
                free = [i for i in free if (hits[i]["block_start"], hits[i]["block_end"]) not in used]
            assert chains.chain_places(hits, strand, "full_gene", max_gap) == anew


def test_a_batch_gives_the_chains_of_each_of_its_groups(spark):
    """Small groups together, an empty hit, many hits, genes and an empty group: as many rows as chains, with the scores of each."""
    rng = random.Random(7)
    rows = []
    for k in range(200):
        hits = group(rng, 40 if k % 50 == 0 else rng.randint(0 if k % 7 == 0 else 1, 6))
        if k % 9 == 0 and hits:
            hits[0]["end"] = hits[0]["start"]
        rows.append({"query_id": str(k), "strand": rng.choice("+-"), "tid": "t", "gene": "g", "model_type": "full_gene" if k % 5 == 0 else "transcript", "mane": k % 2 == 0, "coding": k % 3 == 0, "expected": 2, "max_gap": 90, "hits": hits})
    parse = lambda text: to_arrow_schema(_parse_datatype_string(text))
    batch = pa.RecordBatch.from_pylist(rows, schema=parse(f"{C.FACTS}, hits array<{C.HIT}>"))
    facts = [n for n in batch.schema.names if n != "hits"]
    made = C._chained(batch, facts, parse(C.CALLS), 10.0, C.Options(mane_bonus=3.0)).to_pylist()
    again = C._chained(batch.slice(60), facts, parse(C.CALLS), 10.0, C.Options(mane_bonus=3.0)).to_pylist()
    text = lambda calls: sorted(str(c) for c in calls)
    assert text(again) == text([c for c in made if int(c["query_id"]) >= 60])
    want = []
    for row in rows:
        call = row | {"coding_x": 10.0, "complete_x": 2.0, "mane_x": 3.0}
        for c in chains.chains_of(row["hits"], row["strand"], row["model_type"], 90):
            score = chains.scored(call, c)
            want.append((row["query_id"], [(h["start"], h["end"], h["number"], h["inserted"]) for h in c], score["raw"], score["weighted"], score["found"], score["runs"]))
    shown = [(c["query_id"], [(h["start"], h["end"], h["number"], h["inserted"]) for h in c["hits"]], c["raw"], c["weighted"], c["found"], c["runs"]) for c in made]
    assert sorted(shown) == sorted(want)
