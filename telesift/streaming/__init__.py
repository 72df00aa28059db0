"""The same operators over Structured Streaming.

Every function starts a query and returns it; all take a checkpoint folder, which on a cluster
must be shared, and run to the end of the present input unless another trigger is given.
"""
