"""Graph operators over edge DataFrames."""

from loomgraph.operators.hops import closing_edges, neighbors, one_more_hop, two_hop, two_hop_paths
from loomgraph.operators.degrees import degree_distribution, degrees, max_degree
from loomgraph.operators.sequence import next_edges
from loomgraph.operators.paths import bfs_exist, bfs_length, bfs_levels

__all__ = ["bfs_exist", "bfs_length", "bfs_levels", "closing_edges", "degree_distribution", "degrees", "max_degree", "neighbors", "next_edges", "one_more_hop", "two_hop", "two_hop_paths"]
