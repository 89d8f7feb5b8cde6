"""What can go wrong with a graph's description or arguments."""


class GraphError(Exception):
    """Base of this library's errors."""


class GraphIOError(GraphError):
    """A metadata or side file can't be read."""


class GraphBindError(GraphError):
    """The metadata doesn't have what was asked for."""


class VertexRangeError(GraphError, ValueError):
    """A vertex index outside 0..N-1."""

    def __init__(self, vid: object):
        super().__init__(f"Vertex id is out of range: {vid}")
