"""A fixed term table, so that scoring can be compared with plain SQL."""

from addrwatch.operators.additive import AdditiveModel, Term

FIXED = AdditiveModel(
    terms=(
        Term(("length",), ((-0.55, 0.45),), (-0.42, 0.11, 0.63, 0.02)),
        Term(("log_income",), ((-1.05, 0.05, 0.95),), (-0.71, -0.23, 0.34, 0.82, -0.12)),
        Term(("neighbors_per_length",), ((-0.35,),), (0.27, -0.13, 0.03)),
        Term(("weight",), ((0.101, 0.251),), (-0.31, 0.08, 0.22, 0.04)),
        Term(("looped_per_count",), ((0.0101,),), (-0.17, 0.19, 0.06)),
        Term(("income_per_count",), ((1000.5, 5000.5),), (0.29, -0.05, -0.37, 0.07)),
        Term(("length", "weight"), ((0.05,), (0.15,)), (-0.09, 0.14, 0.46, -0.25, 0.0)),
    ),
    intercept=-0.21,
    threshold=0.57,
)
