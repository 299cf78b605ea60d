"""factline.streaming"""
