"""Writers. Every writer targets a path or table named by the caller; data
that is being replaced is never overwritten in place while it is read."""
