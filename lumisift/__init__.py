"""Spark-first engine for curating media and document records into balanced training sets.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function; nothing here
starts a Spark session except :func:`lumisift.session.get_session`.
"""

__version__ = "0.1.0"
