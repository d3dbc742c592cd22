"""The four end-to-end jobs: news, catalogue, crawl, people."""
