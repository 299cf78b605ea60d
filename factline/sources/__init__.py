"""factline.sources"""
