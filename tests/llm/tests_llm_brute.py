"""Plain Python forms of what the pipeline's stages do."""

import re
from functools import lru_cache

KINDS = ("email", "ip", "card", "phone")


@lru_cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def fingerprint_groups(prints):
    """The smallest doc_id of each group of fingerprints within two bits of each other."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in ids}


def brute_pii_mask(text):
    from test_pii import brute

    spans = sorted((s, KINDS.index(k), e) for k, s, e in brute(text))
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]
