import json
import pickle
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tributary.llm import packing

END = "<|endoftext|>"
TEXTS = [f"hello {END} world", END, f"{END}{END} x", f"a{END}", f"中文 {END}\n\n  next", f"<|endof{END}text|>", "<|endoftext|", "plain", ""]


def test_added_tokens_get_their_own_ids_as_in_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    file = Tokenizer.from_file(path)  # in its default setting
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = packing.pack_documents(docs, packing.broadcast_encoder(spark, path)).collect()
    want = {d: np.array([*file.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in enumerate(TEXTS)}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {d: (len(x), zlib.crc32(x.tobytes())) for d, x in want.items()}
    assert want[0].tolist() == [31373, 220, 50256, 995, 0]


def test_the_longest_added_token_wins_and_the_others_of_a_file_are_read(tmp_path):
    parts = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    parts["added_tokens"] += [dict(parts["added_tokens"][0], id=50257 + k, content=c, special=not k) for k, c in enumerate(["<a>", "<a>b"])]
    path = str(tmp_path / "own.json")
    json.dump(parts, open(path, "w", encoding="utf-8"))
    file, own = Tokenizer.from_file(path), pickle.loads(pickle.dumps(packing.FileEncoder(path)))
    for t in [*TEXTS, "x<a>b y<a> <a>bb", "<a"]:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == file.encode(t, add_special_tokens=False).ids
