"""Training-data operators: URL filters, deduplication, scoring, sharding,
chat formatting, BPE and decontamination.  Nothing else in the library
imports this subpackage."""
