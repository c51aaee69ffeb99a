"""tablesmith: table profiling, cleaning, feature, exploratory-statistics and
experiment-analysis operators on Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame; fitting operators
(means, quantiles, category lists) run one bounded aggregate first and then
apply literals, so plans stay inside whole-stage codegen.
"""

__version__ = "0.1.0"
