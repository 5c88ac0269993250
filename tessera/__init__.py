"""tessera: Spark-native text-corpus preparation.

Modules
-------
functions.keyed     keyed draws ``h60`` / ``u01``
functions.text      Column functions: strip, NFKC, printable filter, clean-up
sources.readers     line / paragraph / JSON-lines / dataset sources
sources.sinks       shard files, vocabulary file, metric tables, cached stages
operators.corpus    lines, sentences, spans, filters
operators.split     shards, train/valid, caps, samples, hash rank
operators.dedup     exact, recency-window and bounded-cache dedup
operators.vocab     words, counts, alphabet, WordPiece learner, vocabulary I/O
operators.encode    WordPiece segmentation, encoding, packing, masking, batching
operators.metrics   argmax, loss, accuracy, perplexity, counts
operators.rowindex  dense positions and running totals without one-task windows
plans.recipes       end-to-end recipes
plans.queries       registered queries with their SQL oracles
streaming.streams   Structured Streaming forms
"""

from tessera.session import checkpoint_dir, get_spark, ship_package

__all__ = ["checkpoint_dir", "get_spark", "ship_package"]
