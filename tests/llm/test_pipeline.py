import hashlib
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tallyworks.llm import packing, quality
from tallyworks.llm.common import table, written
from tests.llm import test_packing, test_pii, test_quality, test_simhash, test_substrings
from tests.llm.conftest import SF


def test_stages_against_plain_python(spark):
    before = table(spark, SF, "documents")
    columns = before.columns
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, before, SF), f"test-{name}")
        old, new = ({r.doc_id: r for r in df.collect()} for df in (before, after)) if name != "pack" else ({r.doc_id: r for r in before.collect()}, {})
        if name == "sound":
            verdict = {r.doc_id: r.kept for r in quality.scored(before, ["doc_id"]).collect()}
            assert set(new) == {i for i, kept in verdict.items() if kept}
            assert not any(test_quality.brute(r.text)[-1] for r in new.values())
        elif name == "near_dedup":
            fps = {i: test_simhash.brute_fingerprint(r.text) for i, r in old.items()}
            assert set(new) == set(test_simhash.brute(fps, 2).values())
        elif name == "cut_repeats":
            expected = {r[0]: r[3] for r in test_substrings.brute([(i, r.text) for i, r in old.items()])}
            assert {i: hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text)).encode()).hexdigest() for i, r in new.items()} == expected
        elif name == "mask_pii":
            assert set(new) == set(old)
            for i, r in new.items():
                if not re.search("[0-9@]", old[i].text):
                    assert r.text == old[i].text
                assert not test_pii.brute(r.text) and not re.search("AKIA[A-Z0-9]{16}", r.text)
        else:
            used, least = test_packing.check(after.collect(), {i: r.text for i, r in old.items()}, 2048)
            assert used <= least + 1
            # the sequences' ids are the stage's whole texts (the tokenizer itself folds case and spaces), and lie where the row says
            tokenizer, docs, sequences = Tokenizer.from_file(packing.word_tokenizer()), {}, {}
            for r in sorted(after.collect(), key=lambda r: (r.doc_id, r.piece)):
                ids = np.frombuffer(r.ids, "<u4").tolist()
                assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
                docs.setdefault(r.doc_id, []).extend(ids)
                sequences.setdefault(r.sequence_id, {})[r.offset] = ids
            assert all(ids[-1] == 0 for ids in docs.values())
            assert docs == {i: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for i, r in old.items()}
            for parts in sequences.values():
                whole = [x for at in sorted(parts) for x in parts[at]]
                assert len(whole) <= 2048 and all(whole[at : at + len(ids)] == ids for at, ids in parts.items())
            break
        assert after.columns == columns
        assert all(r[c] == old[i][c] for i, r in new.items() for c in ("lang", "source"))
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "pack"


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
