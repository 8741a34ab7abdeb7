"""News text preparation as Spark jobs.

Tables in, tables out::

    pages -> links
    pages -> articles -> kept articles -> sentences -> numbered records -> files

``functions`` holds Column -> Column helpers, ``operators`` DataFrame ->
DataFrame steps, ``sources`` readers and writers, ``plans`` the whole jobs.
"""

from pressmill.config import JobConfig

__all__ = ["JobConfig"]
