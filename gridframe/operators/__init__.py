"""DataFrame functions over array stores."""
