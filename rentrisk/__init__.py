"""rentrisk: rent-shortfall analytics on Spark.

Four batch flows, each a composition of DataFrame transforms:

* ``plans.clean``   raw delimited rows -> typed ``payment`` rows with dense random ids
* ``plans.sample``  payment rows below an id cut -> ``train`` rows with SMOTE rows added
* ``plans.train``   train rows -> cross-validated lasso pipeline + validation report
* ``plans.score``   payment rows from the id cut up + model -> one metrics row

Everything is expressed with the DataFrame / SQL / ML API so Catalyst can prune,
push down and code-generate; there are no row-at-a-time UDFs.
"""

__version__ = "0.1.0"
