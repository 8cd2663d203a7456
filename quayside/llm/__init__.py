"""Operators for preparing language-model training text, one module per operator.

* ``winnow``     - benchmark decontamination by winnowed k-gram fingerprints (op1)
* ``toxicity``   - weighted lexicon matched by Aho-Corasick over folded text (op2)
* ``rules``      - quality rules compiled into one projection (op3)
* ``minhash``    - near-duplicate classes by consistent weighted sampling (op4)
* ``classifier`` - hashed subword embeddings with a softmax output (op5)
* ``secret_scan`` - trigram-indexed secret rules (op6)
* ``pages``      - main text of HTML pages by line-block distribution (op7)
* ``bpe``        - byte-level BPE over padded matrices (op8)
* ``frames``     - token ids in seekable zstandard files (op9)
* ``substring``  - repeated word windows by FM-index shards (op10)
* ``whitening``  - embedding whitening by Chebyshev-filtered subspace iteration (op11)
* ``prefix_trie`` - prefix trie of conversations behind a count-min sketch (op12)
* ``warc``       - WARC records in dictionary-compressed archives (op13)

``catalog`` registers one query per operator.  Nothing outside this subpackage imports it.
"""
