"""rankforge: recommendation analytics as Spark DataFrame operators.

Models (popularity, user/item kNN, truncated SVD, hybrid), features, splits,
ranking metrics, model comparison and explanations, all DataFrame in and out.
"""

__version__ = "0.1.0"
