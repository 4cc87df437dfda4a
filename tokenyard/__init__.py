"""tokenyard: language-model text data as Spark DataFrame jobs.

Sub-packages:
  sources    readers (tables, text corpora, tokenizer files, token datasets, run logs)
  functions  Column-level building blocks (pre-tokenizer, pair strings, codecs, vector math)
  operators  DataFrame -> DataFrame operators (counts, BPE learner, encode/decode, windows, scores, runs)
  sinks      writers (tokenizer, token datasets, run logs)
  streaming  Structured Streaming forms of the encode / count / metrics jobs
  plans      the registered queries over the driver tables and their SQL oracles
"""

__version__ = "0.1.0"
