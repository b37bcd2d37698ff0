"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

One module per operator; ``registry`` holds the registered queries.  Nothing else in the
library imports this package."""
