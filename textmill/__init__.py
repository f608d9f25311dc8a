"""textmill: a Spark-native engine for cleaning and filtering large text corpora.

Every operator is either a ``Column -> Column`` expression (``textmill.functions``)
or a ``DataFrame -> DataFrame`` transformation (``textmill.operators``); jobs in
``textmill.plans`` compose them into declarative plans that Catalyst optimises.
"""

from textmill.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
