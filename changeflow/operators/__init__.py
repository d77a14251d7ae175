"""DataFrame-to-DataFrame operators.  Each one works on batches and streams
unless its documentation says otherwise."""
