"""The layered flows of the five datasets, as compositions of operators.

Each module exposes pure ``DataFrame → DataFrame`` layer functions (bronze,
silver, quarantine conditions, gold builders) and a ``run`` that writes every
layer through storage, so each layer is also a lineage cut and a restart
point when executors are lost.
"""
