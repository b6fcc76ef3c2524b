"""Training-data operators: deduplication, decontamination, scoring, sharding
and tokenisation of a ``documents`` table. Nothing else in the library imports
this subpackage; ``catalog`` lists its queries."""
