"""The data flows of the crawl as whole plans over the operators."""
