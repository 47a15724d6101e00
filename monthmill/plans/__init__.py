"""The tables of the two stores, and the jobs that build them."""
