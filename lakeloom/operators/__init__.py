"""DataFrame -> DataFrame operators; none of them touches a target path."""
