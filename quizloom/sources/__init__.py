"""Where rows come from and go to: configuration, files, banks, sinks, and providers of text, vectors and images."""
