"""rankfold: rating, ranking, similarity, graph and text analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing is collected to the
driver except bounded control values (a count per BFS level, one RMSE per grid setting).
"""

from rankfold.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
